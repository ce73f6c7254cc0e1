"""Removal of repeated byte strings against a count of all of them."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from caretide.llm import queries, suffixes

SCHEMA = "doc_id bigint, text string, block string, payload int, spans string, kept int, round string"


def brute(rows, length):
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        edges = [i for i in range(len(b) + 1) if (i < len(b) and mark[i]) != (i > 0 and bool(mark[i - 1]))]
        kept = bytes(x for x, gone in zip(b, mark, strict=True) if not gone)
        out.append((d, len(b), tuple(zip(edges[::2], edges[1::2], strict=True)), kept))
    return sorted(out, key=str)


def cut(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "b", 3, "s", 4, "r") for i, t in rows], SCHEMA).repartition(3)
    found = suffixes.drop_repeated_bytes(docs, **options).collect()
    return sorted([(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in found], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(200)]

    def words(k):
        return " ".join(rng.choices(vocabulary, k=k))

    out = [(k, words(rng.randint(0, 200))) for k in range(20)]
    passage, line, base = words(60), words(22), words(300).split(" ")
    out += [(100 + k, f"{words(rng.randint(3, 40))} {passage} {words(rng.randint(3, 40))}") for k in range(6)]
    out += [(200 + k, words(30) + line + words(30)) for k in range(25)]  # a common line between other words
    out += [(300 + k, " ".join([*base[: 50 * k], f"edit{k}", *base[50 * k + 1 :]])) for k in range(6)]
    out += [(400, "a" * 900), (401, "ab" * 400), (402, "abc" * 300), (403, None), (None, ""), (None, " ".join(base)), (405, " ".join(base)), (405, " ".join(base))]
    out += [(406, passage[:199]), (407, passage[5:230]), (408, ("x" * 150 + "y" * 150) * 2 + "z"), (409, "é" * 100), (410, "é" * 100 + "b")]
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    return [*out, (500, thue), (501, thue.translate(str.maketrans("ab", "ba")))]


OPTIONS = [{}, {"hot_pieces": 2}, {"block_bytes": 2_000, "fan": 2}, {"block_bytes": 3_000, "fan": 3, "hot_pieces": 2}, {"gram": 200}, {"gram": 8}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_equals_a_count_of_all_windows(spark, rows, options):
    assert cut(spark, rows, **options) == brute(rows, 200)


def test_other_lengths(spark, rows):
    assert cut(spark, rows, length=40, gram=10) == brute(rows, 40)
    assert cut(spark, rows, length=1, gram=1) == brute(rows, 1)


def test_empty_table_and_short_texts(spark):
    assert cut(spark, []) == []
    assert cut(spark, [(1, "short"), (2, None), (3, "short")]) == brute([(1, "short"), (2, None), (3, "short")], 200)


def test_runs_across_slices(spark, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "_SLICE", 256)
    assert cut(spark, rows) == brute(rows, 200)


def windows_of(pieces, length):
    count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
    return [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]


@pytest.mark.parametrize("same_values", [False, True])
def test_suffix_sort_is_verified(monkeypatch, same_values):
    """Also if the hash of every byte is the same, so that any two suffixes seem equal."""
    if same_values:
        monkeypatch.setattr(suffixes, "_VALUES", np.full(256, 7, np.uint64))
    rng = random.Random(2)
    pieces = sorted({bytes(rng.choices(b"ab", k=12)) for _ in range(300)})
    n = len(pieces)
    flags = suffixes.repeated_windows(pieces, np.zeros(n, np.uint64), np.full(n, 3), np.zeros(n, bool), 9)
    # Windows are compared at one offset of the anchor: here the place within the piece.
    for at in range(4):
        count = Counter(p[at : at + 9] for p in pieces)
        assert [bool(f[at]) for f in flags] == [count[p[at : at + 9]] > 1 for p in pieces]


def test_suffix_order(monkeypatch):
    rng = random.Random(3)
    data = np.array(rng.choices(b"aab", k=4000), np.uint8)
    at = np.arange(3900)
    sort = suffixes.SuffixSort(data, 100)
    turn, equal = sort.sort(at, np.zeros(len(at), np.int64))
    raw = data.tobytes()
    found = [raw[i : i + 100] for i in turn.tolist()]
    assert found == sorted(found)
    assert equal.tolist() == [False, *[a == b for a, b in zip(found, found[1:], strict=False)]]


def test_query(spark, small):
    documents = [tuple(r) for r in queries.table(spark, small, "documents").select("doc_id", "text").collect()]
    want = sorted((d, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for d, n, spans, kept in brute(documents, 200))
    assert sorted(tuple(r) for r in queries.op13_suffix_dedup(spark, small).collect()) == want
