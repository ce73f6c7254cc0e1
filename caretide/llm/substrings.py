"""Removal of passages that occur more than once, found by level-wise doubling of word windows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caretide.llm.common import (
    ASKED,
    FAN,
    answered,
    asked,
    block_no,
    by_bucket,
    count_blocks,
    distinct_rows,
    documents,
    framed,
    mix,
    packed_blocks,
    squeeze,
    squeeze_sorted,
    unframed,
    unpack,
    unsqueeze,
    unsqueeze_sorted,
    word_digests,
    words_of,
)

WINDOW = 35
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20


def grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` items from each position on; shorter at the end of the array."""
    out, have = hashes, 1
    while have < length:
        step = min(have, length - have)
        out, have = mix(out[: max(len(out) - step, 0)], out[step:]), have + step
    return out


class Windows:
    """The windows of a block's documents, at the three lengths at which they are compared.

    Lengths are a quarter, a half and all of the window, rounded up. At the first length a window
    is represented by its smallest quarter (leftmost if tied): equal windows have it at the same
    offset, so it repeats if the window does, and neighbouring windows mostly share it. At the
    second length that quarter is extended to twice its length, forward if this stays within the
    window, else backward. At the third length the window stands for itself, with 128 bits.
    """

    def __init__(self, group: pa.Table, window: int):
        parts = [word_digests(chunk.column("text")) for chunk in unpack(group)]
        words = np.concatenate([p[0] for p in parts] or [np.empty((0, 2), np.uint64)])
        sizes = np.concatenate([p[1] for p in parts] or [np.empty(0, np.int64)])
        self.window, self.sizes, self.starts = window, sizes, np.cumsum(sizes) - sizes
        n = len(words)
        quarter, half = math.ceil(window / 4), math.ceil(window / 2)
        fits = np.zeros(n + 1, np.int64)
        long = sizes >= window
        np.add.at(fits, self.starts[long], 1)
        np.add.at(fits, (self.starts + sizes - window + 1)[long], -1)
        self.at = np.flatnonzero(np.cumsum(fits[:n]) > 0)
        self.n = n
        if not len(self.at):
            self.keys = [(np.empty(0, np.uint64),)] * 2 + [(np.empty(0, np.uint64),) * 2]
            self.places = [self.at] * 3
            return
        first_words = words[:, 0].copy()
        small, middle = grams(first_words, quarter), grams(first_words, half)
        lowest = (small & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(small), dtype=np.uint64)
        have, span = 1, window - quarter + 1
        while have < span:
            step = min(have, span - have)
            lowest, have = np.minimum(lowest[: len(lowest) - step], lowest[step:]), have + step
        first = (lowest[self.at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        second = np.where(first - self.at + half <= window, first, first + quarter - half)
        self.places = [first, second, self.at]
        # Smallest quarters have small hashes: mixed again, they are dealt out evenly to the buckets.
        whole = tuple(grams(words[:, k].copy(), window)[self.at] for k in (0, 1))
        self.keys = [(mix(small[first], 1),), (middle[second],), whole]

    def repeated(self, level: int, elsewhere: tuple[np.ndarray, ...]) -> np.ndarray:
        """Which windows have a key at this level that also starts at another place."""
        keys, places = self.keys[level], self.places[level]
        if not len(places):
            return np.zeros(0, bool)
        _, distinct = np.unique(places, return_index=True)
        n = len(distinct)
        turn, _, number = distinct_rows(*[np.concatenate([k[distinct], e]) for k, e in zip(keys, elsewhere, strict=True)])
        hit = np.bincount(number)[number] > 1
        by_place = np.zeros(self.n, bool)
        own = turn < n
        by_place[places[distinct[turn[own]]]] = hit[own]
        return by_place[places]

    def questions(self, level: int, which: np.ndarray, block: int, n_buckets: int) -> pa.Table:
        keys = [k[which] for k in self.keys[level]]
        turn, first, _ = distinct_rows(*keys)
        keys = [k[turn[first]] for k in keys]
        none = np.zeros(len(first), bool)
        return asked([(b, block, _question([k[lo:hi] for k in keys], none[lo:hi])) for b, lo, hi in by_bucket(keys[0], n_buckets)])


def _question(keys: list[np.ndarray], often: np.ndarray) -> bytes:
    """Distinct keys in order, of one or two columns, and whether several blocks have them."""
    return framed([squeeze_sorted(keys[0]), *[squeeze(k) for k in keys[1:]], squeeze(often)])


def _read(payload: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    first, *rest, often = unframed(payload)
    return [unsqueeze_sorted(first), *[unsqueeze(k, "<u8") for k in rest]], unsqueeze(often, bool)


def _together(payloads: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [_read(p) for p in payloads]
    keys = [np.concatenate(c) for c in zip(*[p[0] for p in parts], strict=True)]
    often = np.concatenate([p[1] for p in parts])
    turn, first, number = distinct_rows(*keys)
    weight = np.bincount(number, 1 + often[turn], len(first)) if len(turn) else np.empty(0)
    return [k[turn[first]] for k in keys], weight > 1


def _joined(payloads: list[bytes]) -> bytes:
    return _question(*_together(payloads))


def _among(own: list[np.ndarray], others: list[np.ndarray]) -> bytes:
    """A block's own keys that are among others; both distinct."""
    turn, first, number = distinct_rows(*[np.concatenate(c) for c in zip(own, others, strict=True)])
    both = np.bincount(number, minlength=len(first)) > 1
    rows = turn[first[both]]
    return _question([np.concatenate(c)[rows] for c in zip(own, others, strict=True)], np.empty(0, bool))


def _shared(payloads: list[bytes]) -> list[bytes]:
    """Of each block's distinct keys, those that another block has as well."""
    keys, often = _together(payloads)
    common = [k[often] for k in keys]
    return [_among(_read(p)[0], common) for p in payloads]


def _split(own: bytes, _: bytes, reply: bytes) -> bytes:
    return _among(_read(own)[0], _read(reply)[0])


def _elsewhere(replies: pa.Table, columns: int) -> tuple[np.ndarray, ...]:
    parts = [_read(x.as_py())[0] for x in replies.column("payload")]
    return tuple(np.concatenate([p[k] for p in parts] or [np.empty(0, np.uint64)]) for k in range(columns))


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """Each document without the words of passages that occur more than once.

    A window is ``window`` consecutive words of one document. A word goes if some window that
    covers it starts anywhere else too, in the same document or another one; windows are judged
    on the input. Returns ``doc_id, n_words, n_removed, kept_text, kept_sha256`` (kept words
    joined by one space), one row per input row.

    Level-wise doubling: windows are first compared by a quarter of their length, only those
    whose quarter repeats by a half, and only those whose half repeats in full; a level without
    candidates asks nothing. Each level is one exchange of packed distinct hashes; texts are
    exchanged once. The last comparison is by 128 bits, made of cryptographic digests of the words;
    those before it only choose candidates.

    Null text counts as empty; null and repeated ids are kept (repeated rows repeat each other's
    passages); documents shorter than a window lose nothing; an empty table gives no rows; other
    columns are ignored. A document must fit in a task's memory.
    """
    docs = documents(docs)
    n_blocks, n_buckets = count_blocks(docs, block_bytes, BUCKET_BYTES)
    blocks = packed_blocks(docs, n_blocks)

    def first(group: pa.Table) -> pa.Table:
        found = Windows(group, window)
        return found.questions(0, np.ones(len(found.at), bool), block_no(group), n_buckets)

    def second(group: pa.Table, replies: pa.Table) -> pa.Table:
        found = Windows(group, window)
        return found.questions(1, found.repeated(0, _elsewhere(replies, 1)), block_no(group), n_buckets)

    def third(group: pa.Table, replies: pa.Table) -> pa.Table:
        found = Windows(group, window)
        return found.questions(2, found.repeated(1, _elsewhere(replies, 1)), block_no(group), n_buckets)

    def cut(group: pa.Table, replies: pa.Table) -> pa.Table:
        found = Windows(group, window)
        gone = found.at[found.repeated(2, _elsewhere(replies, 2))]
        cover = np.zeros(found.n + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        covered = np.cumsum(cover)[:-1] > 0
        ids, removed, kept, doc = [], [], [], 0
        for chunk in unpack(group):
            ids += chunk.column("doc_id").to_pylist()
            for text in chunk.column("text").to_pylist():
                words = words_of(text)
                mask = covered[found.starts[doc] : found.starts[doc] + len(words)]
                removed.append(int(mask.sum()))
                kept.append(" ".join([w for w, out in zip(words, mask.tolist(), strict=True) if not out] if removed[-1] else words))
                doc += 1
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(found.sizes),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept], pa.string()),
            }
        )

    def level(step, replies: DataFrame) -> DataFrame:
        return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(step, ASKED)

    def ask(questions: DataFrame) -> DataFrame:
        return answered(questions, _shared, _joined, _split, n_blocks, fan)

    replies = ask(blocks.groupBy("block").applyInArrow(first, ASKED))
    replies = ask(level(second, replies))
    replies = ask(level(third, replies))
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(cut, out)
