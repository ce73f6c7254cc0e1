"""A Merkle manifest of documents whose parents keep the hash states before each of their children."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.operators.ranks import PART, range_parts
from caretide.session import materialize

#: Children of a node.
FAN = 16
#: Levels of the tree that one task holds, so that a task has at most FAN ** CHUNK_LEVELS nodes at the bottom.
CHUNK_LEVELS = 3

#: A parent's digests left and right of the child that a proof goes through.
PATH = "array<struct<left: string, right: string>>"
PROOFS = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def sized(value: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The document's leaf: SHA-256 of its columns, each preceded by its length."""
    return F.sha2(F.concat(*[sized(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


class Parent:
    """A node over at most ``FAN`` children: its digest, and the hash state before each child slot.

    To fold another digest into a slot, the state before the slot is resumed with that digest and
    the siblings right of it; the siblings on the left are in the state already.
    """

    def __init__(self, children: Sequence[bytes]):
        self.states, self.rights, self.others = [], [], []
        running, whole = sha256(), b"".join(children)
        at = 0
        for child in children:
            self.states.append(running.copy())
            running.update(child)
            self.rights.append(whole[at + len(child) :])
            self.others.append(whole[:at] + self.rights[-1])
            at += len(child)
        self.digest = running.hexdigest().encode()

    def folded(self, slot: int, digest: bytes) -> bytes:
        return resumed(self.states[slot], digest, self.rights[slot])


def resumed(state, digest: bytes, right: bytes) -> bytes:
    """The parent's digest with ``digest`` in the slot after ``state``."""
    again = state.copy()
    again.update(digest)
    again.update(right)
    return again.hexdigest().encode()


def levels_over(digests: list[bytes], chunk: int, fan: int, levels: int) -> Iterator[list[Parent]]:
    """The levels of parents over a chunk of consecutive nodes of a tree.

    The first chunk ends where a single node is left. Another chunk is never all of its tree, so
    it goes up all levels, even with a single node; so does a first chunk with others after it,
    which is full.
    """
    done = 0
    while len(digests) > 1 or (chunk and done < levels):
        parents = [Parent(digests[i : i + fan]) for i in range(0, len(digests), fan)]
        yield parents
        digests, done = [p.digest for p in parents], done + 1


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, the row's number from 0 within its group in the given order (nulls first).

    The table is cut into ranges of (group, order), so a group of any size is numbered by many
    tasks; rows equal in all of ``order`` are dealt out by their place in the stored table.
    """
    placed = df.withColumn("place", F.monotonically_increasing_id())
    ranged = range_parts(placed, [F.col(group), *[F.col(c) for c in order], F.col("place")])
    counts = ranged.groupBy(group, PART).agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("of"), F.col(PART).alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(PART, group).orderBy(*order, "place")
    local = ranged.withColumn("rn", F.row_number().over(inside))
    joined = local.join(offsets, (F.col(PART) == F.col("at")) & (F.col(group) == F.col("of")))
    return joined.select(*df.columns, (F.col("offset") + F.col("rn") - 1).alias("pos"))


def _top(fan: int, levels: int):
    def top(key: tuple, group: pa.Table) -> pa.Table:
        tree, chunk = key[0].as_py(), key[1].as_py()
        digests = [d.encode() for d in group.sort_by("pos").column("digest").to_pylist()]
        for parents in levels_over(digests, chunk, fan, levels):
            digests = [p.digest for p in parents]
        return pa.table({"tree": pa.array([tree], pa.string()), "pos": pa.array([chunk], pa.int64()), "digest": pa.array([digests[0].decode()], pa.string())})

    return top


def _paths(fan: int, levels: int):
    def paths(key: tuple, group: pa.Table) -> pa.Table:
        chunk, group = key[1].as_py(), group.sort_by("pos")
        digests = [d.encode() for d in group.column("digest").to_pylist()]
        steps: list[list[dict]] = [[] for _ in digests]
        nodes, width = digests, 1
        for parents in levels_over(digests, chunk, fan, levels):
            for i, path in enumerate(steps):
                parent, slot = parents[i // width // fan], i // width % fan
                right = parent.rights[slot]
                other = parent.others[slot]
                path.append({"left": other[: len(other) - len(right)].decode(), "right": right.decode()})
            nodes, width = [p.digest for p in parents], width * fan
        n = len(digests)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        columns = {"tree": group.column("tree"), "pos": group.column("pos"), "chunk": pa.array([chunk] * n, pa.int64())}
        return pa.table(columns | {"path": pa.array(steps, kind), "top": pa.array([nodes[0].decode()] * n, pa.string())})

    return paths


def climb(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """``tree, pos, path, top``: each node's siblings up to the top of its tree, and the top.

    ``nodes`` is ``tree, pos, digest``. A task takes a chunk of ``fan ** levels`` nodes; the tops
    of the chunks are the nodes of the next pass, so the table shrinks by that factor each time.
    """
    size = fan**levels
    chunked = nodes.withColumn("chunk", F.floor(F.col("pos") / size).cast("bigint"))
    solved = materialize(chunked.groupBy("tree", "chunk").applyInArrow(_paths(fan, levels), f"tree string, pos bigint, chunk bigint, path {PATH}, top string"), "merkle")
    if not solved.filter("chunk > 0").take(1):
        return solved.select("tree", "pos", "path", "top")
    tops = solved.filter(F.col("pos") % size == 0).select("tree", F.col("chunk").alias("pos"), F.col("top").alias("digest"))
    above = climb(tops, fan, levels).select("tree", F.col("pos").alias("chunk"), F.col("path").alias("rest"), F.col("top").alias("end"))
    return solved.join(above, ["tree", "chunk"]).select("tree", "pos", F.concat("path", "rest").alias("path"), F.col("end").alias("top"))


@dataclass
class Manifest:
    """``leaves``: ``tree, chunk, pos, doc_id, leaf, other``; ``chunks``: the way from each chunk to the root."""

    leaves: DataFrame
    chunks: DataFrame
    fan: int
    levels: int


def build(docs: DataFrame, changed_text: Column | None = None, fan: int = FAN, levels: int = CHUNK_LEVELS) -> Manifest:
    """The manifest's stored leaves and the ways up from their chunks.

    ``changed_text`` (over the columns of ``docs``) is a text that the document may have now; a
    null leaves the document as it is. It is hashed beside the original for :func:`verify`.
    """
    original = [F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars"), F.col("text").cast("string")]
    other = F.lit(None).cast("string") if changed_text is None else F.when(changed_text.isNotNull(), leaf_hash(*original[:4], changed_text))
    # A source as a string that sorts as bytes, with null first and apart from the empty one.
    tree = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), original[1]))
    hashed = materialize(docs.select(tree.alias("tree"), original[0].alias("doc_id"), leaf_hash(*original).alias("leaf"), other.alias("other")), "leaves")
    chunk = F.floor(F.col("pos") / fan**levels).cast("bigint")
    leaves = materialize(numbered(hashed, "tree", ["doc_id", "leaf"]).withColumn("chunk", chunk), "leaves")

    bottoms = leaves.select("tree", "chunk", "pos", F.col("leaf").alias("digest"))
    tops = materialize(bottoms.groupBy("tree", "chunk").applyInArrow(_top(fan, levels), "tree string, pos bigint, digest string"), "merkle")
    within = climb(tops, fan, levels).withColumnRenamed("top", "subroot")
    subroots = materialize(within.filter("pos = 0").select(F.lit("").alias("all"), "tree", "subroot"), "merkle")
    sources = numbered(subroots, "all", ["tree"]).select(F.col("all").alias("tree"), "pos", F.col("subroot").alias("digest"), F.col("tree").alias("of"))
    sources = materialize(sources, "merkle")
    above = climb(sources.drop("of"), fan, levels).select("pos", F.col("path").alias("rest"), F.col("top").alias("root"))
    ends = sources.select("of", "pos").join(above, "pos").select(F.col("of").alias("tree"), "rest", "root")
    ways = within.join(ends, "tree").select("tree", F.col("pos").alias("chunk"), F.concat("path", "rest").alias("path"), "subroot", "root")
    return Manifest(leaves, materialize(ways, "merkle"), fan, levels)


def verify(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row per document.

    ``proof_sha256`` is of the siblings from the leaf up to the root, left to right on each
    level. ``folded_root`` is recomputed from the document's changed leaf, or else its own, along
    the same siblings: a task rebuilds the parents of its chunk once, and once the states before
    the slots on the chunk's way up; every fold only resumes copies of these states.
    """
    fan, levels = manifest.fan, manifest.levels

    def fold(leaves: pa.Table, ways: pa.Table) -> pa.Table:
        leaves, (way,) = leaves.sort_by("pos"), ways.to_pylist()
        own = [d.encode() for d in leaves.column("leaf").to_pylist()]
        now = [d.encode() if d else o for d, o in zip(leaves.column("other").to_pylist(), own, strict=True)]
        tiers = list(levels_over(own, way["chunk"], fan, levels))
        above = [(sha256(step["left"].encode()), step["right"].encode()) for step in way["path"]]
        end = "".join(step["left"] + step["right"] for step in way["path"]).encode()
        proofs, roots = [], []
        for i, digest in enumerate(now):
            proof, at = sha256(), i
            for parents in tiers:
                parent, slot = parents[at // fan], at % fan
                proof.update(parent.others[slot])
                digest, at = parent.folded(slot, digest), at // fan
            for state, right in above:
                digest = resumed(state, digest, right)
            proof.update(end)
            proofs.append(proof.hexdigest())
            roots.append(digest.decode())
        return pa.table(
            {
                "doc_id": leaves.column("doc_id"),
                "leaf": leaves.column("leaf"),
                "subroot": pa.array([way["subroot"]] * len(own), pa.string()),
                "root": pa.array([way["root"]] * len(own), pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(roots, pa.string()),
            }
        )

    groups = manifest.leaves.groupBy("tree", "chunk").cogroup(manifest.chunks.groupBy("tree", "chunk"))
    return groups.applyInArrow(fold, PROOFS).withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(docs: DataFrame, changed_text: Column | None = None, fan: int = FAN, levels: int = CHUNK_LEVELS) -> DataFrame:
    """Every document's proof of inclusion, checked against its changed text (see :func:`verify`).

    A leaf is the hash of ``doc_id, source, lang, n_chars, text``. Per source, the leaves ascend
    by ``doc_id``; while several nodes remain, every ``fan`` consecutive ones become one. The
    subroots, ordered by source, likewise give the root.

    A source of any size is cut into chunks of ``fan ** levels`` leaves, so no task holds more.
    Nulls have a form of their own in the leaf; null ids come first, a null source is a tree of
    its own before all others; rows with equal ids are ordered by their leaf, equal rows are
    leaves beside each other. An empty table gives no rows; other columns are ignored.
    """
    return verify(build(docs, changed_text, fan, levels))
