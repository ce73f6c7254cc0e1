"""Many-term matching against one test per term and text."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from caretide.operators import terms as tm


def brute(texts, terms):
    return sorted({(i, t) for i, text in enumerate(texts) if text is not None for t in terms if t and t in text})


def sample(seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choices("abé ☃𝄞", k=rng.choice([0, 1, 5, 40, 3000]))) for _ in range(60)] + [None, "", "aaaa", "she sells ushers hers"]
    terms = ["".join(rng.choices("abé ☃𝄞", k=rng.randint(1, 7))) for _ in range(300)] + ["he", "she", "his", "hers", "a", "aa", "aaaa", "aaaaa", "nothing here"]
    return texts, sorted(set(terms))


def test_automaton_equals_one_test_per_term():
    texts, terms = sample()
    automaton = tm.Automaton.of([t.encode() for t in terms])
    text, number = automaton.matches(pa.array(["" if t is None else t for t in texts]))
    assert sorted(zip(text.tolist(), [terms[n] for n in number.tolist()], strict=True)) == brute(texts, terms)
    sliced = automaton.matches(pa.array(["" if t is None else t for t in texts])[5:20])
    assert sorted(zip(sliced[0].tolist(), [terms[n] for n in sliced[1].tolist()], strict=True)) == brute(texts[5:20], terms)


def test_terms_over_the_ends_of_lanes():
    term = "x" * 700 + "end"
    texts = ["y" * k + term for k in range(0, 2100, 97)] + ["y" * 5000, term[:-1] * 4]
    automaton = tm.Automaton.of([term.encode(), b"end", b"xe"])
    text, number = automaton.matches(pa.array(texts))
    assert sorted(zip(text.tolist(), number.tolist(), strict=True)) == sorted((i, n) for i, t in enumerate(texts) for n, w in enumerate([term, "end", "xe"]) if w in t)


@pytest.mark.parametrize("max_bytes", [tm.MAX_BYTES, 20_000])
def test_contained_terms(spark, max_bytes):
    texts, terms = sample(2)
    frame = spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)], "id int, text string, match string, row int").repartition(3)
    table = spark.createDataFrame([(t, k, 0) for k, t in enumerate(terms)] + [("", -1, 0), (None, -2, 0), ("he", -3, 0)], "term string, number int, searched int")
    found = tm.contained_terms(frame.drop("match"), table, max_bytes=max_bytes)
    assert found.columns == ["id", "text", "row", "match"]
    got = sorted((r["id"], r["match"]["term"]) for r in found.filter("match.number >= 0").collect())
    assert got == brute(texts, terms)
    assert {r["id"] for r in found.filter("match.number = -3").collect()} == {i for i, t in brute(texts, ["he"])}
    assert found.filter("match.number IN (-1, -2)").count() == 0


def test_no_terms_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a")], "id int, text string")
    none = spark.createDataFrame([], "term string")
    assert tm.contained_terms(texts, none).count() == 0
    assert tm.contained_terms(texts.limit(0), spark.createDataFrame([("a",)], "term string")).count() == 0


def test_search_is_bounded_whatever_the_batch_holds():
    texts = ["a" * 1000 + str(i) for i in range(8000)] + ["", "b" * 3 + "a" * 100_000]
    terms = [*("a" * k for k in range(1, 31)), "7a", *(str(i) for i in range(10))]
    row = pa.array([{"id": i, "text": t} for i, t in enumerate(texts)], pa.struct([("id", pa.int64()), ("text", pa.string())]))
    batch = pa.RecordBatch.from_arrays([row, pa.array(texts)], ["row", "searched"])
    words = sorted(terms)
    automaton = tm.Automaton.of([w.encode() for w in words])
    found, largest, most = [], 0, 0
    tracemalloc.start()
    for piece in tm._search(automaton, words, iter([batch])):
        largest, most = max(largest, piece.num_rows), max(most, piece.nbytes)
        found.append((piece.column("row").field("id").to_numpy(), piece.column("term").to_pylist()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = [(int(i), t) for ids, names in found for i, t in zip(ids, names, strict=True)]
    assert sorted(got) == brute(texts, terms)
    assert largest <= tm._OUT_ROWS and most < 2 * tm._OUT_BYTES and peak < 120 << 20


def test_pieces_hold_every_row_once():
    texts = ["x" * n for n in (0, 3, 50, 1, 1, 9, 0, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    pieces = [p.column("t").to_pylist() for p in tm._cut(batch, "t", 10)]
    assert [t for p in pieces for t in p] == texts and [len(p) for p in pieces] == [2, 1, 2, 2, 2]
    assert list(tm._cut(batch.slice(0, 0), "t", 10)) == []
