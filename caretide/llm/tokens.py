"""Vocabularies of public tokenizers, read from a path that is a parameter, and pre-tokens."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from typing import Any

#: Fixed value: the pattern that splits text before the merges of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of Latin letters, in the syntax of the faster standard engine.
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters on which the two engines' classes may differ.
_OTHER = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


@lru_cache(1)
def _spelt() -> Any:
    """The pattern with its classes spelt out as the ranges that the encoding library's engine has.

    Other engines have tables of other Unicode versions. The library encodes only what its
    pattern matches; so, given a class as the pattern and all characters as the text, it tells
    the members of the class.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}

    def members(sign: str) -> str:
        engine = tiktoken.Encoding("class", pat_str=sign, mergeable_ranks=single, special_tokens={})
        return _ranges([ord(c) for c in bytes(engine.encode_ordinary(every)).decode()])

    letter, number, space = map(members, (r"\p{L}", r"\p{N}", r"\s"))
    spelt = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    for sign, spelled in ((r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\s", f"[{space}]"), (r"\S", f"[^{space}]")):
        spelt = spelt.replace(sign, spelled)
    return re.compile(spelt)


def _ranges(points: list[int]) -> str:
    """Ascending code points as the content of a character class."""
    out, lo = [], points[0]
    for at, point in enumerate(points):
        if at + 1 == len(points) or points[at + 1] != point + 1:
            out.append(f"\\U{lo:08x}-\\U{point:08x}")
            lo = points[at + 1] if at + 1 < len(points) else lo
    return "".join(out)


def pretokens(text: str) -> list[str]:
    """The pattern's matches; they cover the text."""
    return _spelt().findall(text) if _OTHER.search(text) else _LATIN.findall(text)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    """``{token bytes: rank}`` of a ``.tiktoken`` or byte-level BPE ``.json`` file.

    A ``.json`` file is accepted if its merges come in the order of the ids they make, which is
    what makes rank and id the same; special tokens are left out.
    """
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    letters, model = _byte_letters(), whole["model"]
    special = {t["content"] for t in whole.get("added_tokens", ())}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged) or whole.get("normalizer"):
        raise ValueError(f"{path} is no byte-level BPE whose ids follow its merges")
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


def read_added(path: str) -> dict[str, int]:
    """``{content: id}`` of the tokens that a ``.json`` file adds to its vocabulary.

    Wherever a text holds such a content, it is one token; only plain ones are supported, which
    are neither stripped nor bound to whole words.
    """
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", ())
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError(f"{path} adds tokens that take in what is beside them")
    return {t["content"]: t["id"] for t in added}


def encoding(ranks: dict[bytes, int], added: dict[str, int] | None = None):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added or {})
