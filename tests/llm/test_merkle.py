"""The manifest against a tree hashed anew for every changed leaf."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from caretide.llm import merkle, queries

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, pos bigint, chunk string, leaf string, root int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def climb(nodes, at, fan):
    """The root over ``nodes``, and the siblings of node ``at`` up to it."""
    siblings = []
    while len(nodes) > 1:
        run = nodes[at // fan * fan : at // fan * fan + fan]
        siblings += [x for k, x in enumerate(run) if k != at % fan]
        nodes, at = [h(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)], at // fan
    return nodes[0], siblings


def brute(rows, fan):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(trees[s], key=lambda x: x[:3]) for s in order}
    subroots = [climb([x[2] for x in leaves[s]], 0, fan)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        for at, (known, doc_id, own, row) in enumerate(leaves[s]):
            digests = [x[2] for x in leaves[s]]
            subroot, below = climb(digests, at, fan)
            root, above = climb(subroots, k, fan)
            now = own
            if known and zlib.crc32(str(doc_id).encode()) % 5 == 0 and row[4] is not None:
                now = leaf(*row[:4], row[4].translate(LOWER))
            digests[at] = now
            changed = list(subroots)
            changed[k] = climb(digests, at, fan)[0]
            folded = climb(changed, k, fan)[0]
            out.append((row[0], own, subroot, root, h(*below, *above), folded, folded == root))
    return sorted(out, key=str)


def audited(spark, rows, fan=16, levels=3):
    docs = spark.createDataFrame([(*r, "t", 5, "c", "l", 1) for r in rows], SCHEMA).repartition(3)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values()))))
    return sorted([tuple(r) for r in merkle.audit(docs, changed, fan, levels).collect()], key=str)


def rows():
    out = [(k * 7 % 101, f"src{k % 3 and 1}", ["en", None][k % 2], k, f"Text {k} É ÀB") for k in range(90)]
    out += [(None, "src1", "en", None, "No id"), (None, None, None, None, None), (3, None, "de", 4, ""), (3, None, "de", 5, "SAME id"), (3, "", "de", 4, "EMPTY source")]
    out += [(17, "zé", "en", 1, "X" * 70_000), (5, "zz", "en", 0, None)]
    return out + [out[0], out[0], out[0], (out[0][0], *out[0][1:4], "other text, same id")]


@pytest.mark.parametrize(("fan", "levels"), [(16, 3), (2, 1), (3, 2), (4, 1)])
def test_equals_a_tree_hashed_anew(spark, fan, levels):
    found = audited(spark, rows(), fan, levels)
    assert found == brute(rows(), fan)
    assert {True, False} == {r[-1] for r in found}


def test_many_sources_and_one_source(spark):
    many = [(k, f"s{k}", None, 1, "A b") for k in range(40)]
    assert audited(spark, many, 2, 1) == brute(many, 2)
    one = [(k, None, None, 1, "A b") for k in range(64)]
    assert audited(spark, one, 4, 1) == brute(one, 4)  # full chunks only
    assert audited(spark, one[:1]) == brute(one[:1], 16)


def test_repeated_rows_only(spark):
    same = [(5, "s", "en", 3, "A repeated row")] * 50
    assert audited(spark, same, 3, 2) == brute(same, 3)


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_a_fold_resumes_the_state_before_its_slot():
    children = [h(str(k)).encode() for k in range(16)]
    parent = merkle.Parent(children)
    for slot in (0, 7, 15):
        replaced = [*children[:slot], b"x" * 64, *children[slot + 1 :]]
        assert parent.folded(slot, b"x" * 64) == hashlib.sha256(b"".join(replaced)).hexdigest().encode()
    assert parent.digest == hashlib.sha256(b"".join(children)).hexdigest().encode()


def test_query(spark, small):
    out = queries.op11_merkle_manifest(spark, small)
    documents = [tuple(r) for r in queries.table(spark, small, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute(documents, 16)
