"""The filter audit against filters applied one document at a time."""

import itertools
import random
import re

import pytest

from caretide.llm import interactions, queries

DOCS = "doc_id bigint, text string, source string, part string, mask int, n bigint, good boolean, digest string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def brute(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    smallest = {}
    for d, t, _ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    docs = []
    for d, t, s in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)}
        fails |= {"D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > smallest[t]}
        docs.append((s or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, shapley, steps = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                earlier = set(order[:k])
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                counts = (len(left), len(gone), sum(f in d[1] and bool(d[1] & earlier) for d in own), sum(d[1] == {f} for d in own))
                steps.append(("".join(order), k + 1, *counts, sum(d[2] for d in gone), sum(d[3] for d in gone), f))
        out += [(part, *s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "p", 1, 2, True, "d") for r in rows], DOCS).repartition(3)
    marks = spark.createDataFrame([(*r, "p") for r in labels], LABELS)
    return sorted(tuple(r) for r in interactions.audit_filters(docs, marks).collect())


def sample():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)] + ["BIG", "$5", "a|b", "x\x1cy", "é"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 5, 49, 50, 90]))) for _ in range(25)]
    texts += [" ".join(rng.choices(words[:20], k=80)), "SHOUT " * 60, None, "", "   \n", "ok " * 30 + "100%  ", "word " * 9000]
    rows = [(k * 13 % 97, rng.choice(texts), rng.choice(["a", "b", None, ""])) for k in range(90)]
    rows += [(None, texts[0], "a"), (None, texts[0], "a"), (None, None, None), (7, texts[1], "a"), (7, texts[1], "b"), (7, texts[1], "b"), (200, texts[1], "zero")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d, *_ in rows[::2]] + [(None, 1, 1), (7, 1, 0), (7, 0, 1), (9999, 1, 1)]
    return rows, labels


def test_equals_filters_applied_one_by_one(spark):
    rows, labels = sample()
    found = audited(spark, rows, labels)
    assert len(found) == 600 * 4
    assert found == brute(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    rows, _ = sample()
    assert audited(spark, rows, []) == brute(rows, [])


def test_one_text_in_all_rows(spark):
    rows = [(k, "the same text", "a") for k in range(300)]
    assert audited(spark, rows, [(0, 1, 0), (5, 1, 1)]) == brute(rows, [(0, 1, 0), (5, 1, 1)])


def test_more_rows_than_the_row_limit_of_recursive_queries(spark):
    cells = spark.range(40).selectExpr("concat('s', id) AS part", "explode(sequence(0, 31)) AS mask", "1L AS n", "0L AS good", "0L AS toxic")
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1000")
    try:
        assert interactions.audit_orders(cells).count() == 40 * 600
    finally:
        spark.conf.set(limit, before)


@pytest.mark.parametrize("letters", ["E", "EA"])
def test_fewer_filters(spark, letters):
    cells = spark.createDataFrame([("p", m, 3, 1, 2) for m in range(2 ** len(letters))], "part string, mask int, n bigint, good bigint, toxic bigint")
    found = interactions.audit_orders(cells, letters).collect()
    assert len(found) == len(letters) * len(list(itertools.permutations(letters)))


def test_query(spark, small):
    rows = [tuple(r) for r in queries.table(spark, small, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in queries.table(spark, small, "labels").select("doc_id", "quality", "toxic").collect()]
    assert sorted(tuple(r) for r in queries.op12_filter_interactions(spark, small).collect()) == brute(rows, labels)
