"""N-gram Jaccard join: MinHash LSH forest for candidates, exact sets for the answer."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import components, documents, mix, release_memory, shuffle_parts, small_slices, text_hash, word_hashes
from caretide.llm.substrings import grams
from caretide.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
#: Trees of the forest, length of the prefixes it starts with, and expected recall to reach.
TREES, DEPTH, RECALL = 32, 6, 0.99
#: Share of equal signature bytes from which two members of a bucket are put in one cluster:
#: over four standard deviations below the share expected at the similarity.
SKETCH_SHARE = 0.65
#: Members compared in one task: larger buckets and clusters are cut into parts, pair by pair.
BUCKET_PART, CLUSTER_PART = 2_048, 512


def shingle_sets(texts: pa.ChunkedArray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` words; a shorter text is one run."""
    hashes, counts = word_hashes(texts)
    runs, out, at = grams(hashes, size), [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        else:
            out.append(mix(grams(hashes[at : at + n], n), n) if n else hashes[:0])
        at += n
    return out


def node_of(shingles: np.ndarray) -> tuple[int, int]:
    """A 63-bit number for a set, and 63 further bits: equal sets are one node."""
    digest = blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little") >> 1, int.from_bytes(digest[8:], "little") >> 1


def told_apart(sketched: DataFrame) -> DataFrame:
    """The sketches with other numbers where different sets got the same one (``check`` tells them)."""
    several = sketched.groupBy("node").agg(F.min("check").alias("least"), F.max("check").alias("most")).filter("least < most").select("node", "least")
    if not several.take(1):
        return sketched.drop("check")
    marked = sketched.join(several, "node", "left")
    other = F.shiftrightunsigned(F.xxhash64("node", "check"), 1)
    node = F.when(F.col("least").isNull() | (F.col("check") == F.col("least")), F.col("node")).otherwise(other)
    return marked.withColumn("node", node).drop("check", "least")


def signatures(length: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return random.integers(0, 2**63, length, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**64, length, np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    lowest = np.full(len(factors), 2**32 - 1, np.uint32)
    for lo in range(0, len(shingles), 4096):
        values = shingles[lo : lo + 4096, None] * factors + shifts
        lowest = np.minimum(lowest, (values >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return lowest


def collision_chance(similarity, trees: int, depth: int):
    """Chance that two sets share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def _sketched(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """``doc_id, th, node, check, sketch``: the text's hash, its shingle set's number and signature."""
    factors, shifts = signatures(trees * depth)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch):
                sets = shingle_sets(part.column("text"))
                nodes, checks = zip(*[node_of(s) if len(s) else (None, None) for s in sets], strict=True)
                marks = [signature(s, factors, shifts).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), pa.array(marks, pa.binary())], ["doc_id", "th", "node", "check", "sketch"])

    return docs.select("doc_id", "text", text_hash(F.col("text")).alias("th")).mapInArrow(sketch, "doc_id bigint, th binary, node bigint, check bigint, sketch binary")


def _parts(frame: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Each member's rows for the pairs of parts of its group: ``lo, hi, part``. A group of at most
    ``limit`` members is one part."""
    n = F.ceil(size / limit)
    part = F.pmod(F.xxhash64("node", F.lit(3)), n)
    rows = frame.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)))
    return rows.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop("other")


def _together(frame: DataFrame, keys: list[str], n_tasks: int, work, schema: str) -> DataFrame:
    """Many small groups per task call: whole groups, ordered by their keys."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(k, "ascending") for k in keys])
        change = np.zeros(max(group.num_rows - 1, 0), bool)
        for k in keys:
            change |= np.diff(group.column(k).to_numpy()) != 0
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), group.num_rows]
        out = work(group, cuts)
        release_memory()
        return out

    return frame.withColumn("call", F.pmod(F.xxhash64(*keys), F.lit(n_tasks))).groupBy("call").applyInArrow(run, schema)


def _bucket_edges(group: pa.Table, cuts: list[int], share: float) -> pa.Table:
    """``a, b``: a spanning tree of each cluster of alike signatures in a bucket."""
    nodes = group.column("node").to_numpy()
    bytes_of = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(len(nodes), -1)
    need = share * bytes_of.shape[1]
    a, b = [], []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        left = np.arange(lo, hi)
        while len(left) > 1:
            root, left, stack = left[0], left[1:], [left[0]]
            while stack and len(left):
                same = (bytes_of[left] == bytes_of[stack.pop()]).sum(axis=1) >= need
                stack += left[same].tolist()
                a += [nodes[root]] * int(same.sum())
                b += nodes[left[same]].tolist()
                left = left[~same]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def candidate_clusters(nodes: DataFrame, trees: int, depth: int, prefix: int) -> DataFrame:
    """``node, root``: clusters of nodes joined by buckets, for prefixes of the given length.

    A tree's bucket is a run of equal prefixes among its sorted signatures. Members of a bucket
    whose signatures are alike are joined by a spanning tree, never pair by pair.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(batch.num_rows, trees, depth)
            hashed = np.broadcast_to(np.arange(trees, dtype=np.uint64), (batch.num_rows, trees))
            for k in range(prefix):
                hashed = mix(hashed, marks[:, :, k].astype(np.uint64))
            node = np.repeat(batch.column("node").to_numpy(), trees)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(hashed.ravel().astype(np.int64))], ["node", "bucket"])

    def low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [np.frombuffer(x, np.uint32).astype(np.uint8).tobytes() for x in batch.column("sketch").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(marks, pa.binary())], ["node", "marks"])

    prefixes = nodes.select("node", "sketch").mapInArrow(keys, "node bigint, bucket bigint")
    crowded = prefixes.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(prefixes.join(crowded, "bucket"), "buckets")
    marks = nodes.select("node", "sketch").mapInArrow(low_bytes, "node bigint, marks binary")
    split = _parts(members.join(marks, "node"), "bucket", F.col("size"), BUCKET_PART)
    n_tasks = max(shuffle_parts(nodes.sparkSession), math.ceil(members.count() / 50_000))
    edges = _together(split, ["bucket", "lo", "hi"], n_tasks, lambda g, cuts: _bucket_edges(g, cuts, SKETCH_SHARE), "a bigint, b bigint")
    return components(edges, "clusters")


def _links(group: pa.Table, cuts: list[int], similarity: float, chance) -> pa.Table:
    """``root, node, peer, links, expected``: exact links of each member within its group."""
    out: list[tuple] = []
    sets = [np.frombuffer(x, "<u8") for x in group.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets], np.int64)
    root, node, copies, part, lo, hi = (group.column(c).to_numpy() for c in ("root", "node", "copies", "part", "lo", "hi"))
    for a, b in zip(cuts, cuts[1:], strict=False):
        inter = _intersections(sets[a:b])
        union = sizes[a:b, None] + sizes[None, a:b] - inter
        alike = inter / union
        linked = alike >= similarity
        np.fill_diagonal(linked, False)
        if lo[a] != hi[a]:  # pairs within a part are counted where the part meets itself
            linked &= part[a:b, None] != part[None, a:b]
        weight = np.where(linked, copies[None, a:b], 0)
        chances = np.where(linked, chance(alike), 0)
        peer = _lowest_linked(linked, node[a:b])
        out.append((root[a:b], node[a:b], peer, weight.sum(axis=1), linked.sum(axis=1), chances.sum(axis=1), np.full(b - a, lo[a] != hi[a])))
    names = ("root", "node", "peer", "links", "pairs", "expected", "cut")
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 7
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, [pa.int64()] * 5 + [pa.float64(), pa.bool_()], strict=True)})


LINKS = "root bigint, node bigint, peer bigint, links bigint, pairs bigint, expected double, cut boolean"


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices, some columns at a time.

    Shingles that the same members have are one column, weighted by their number.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.append(starts, len(values)))
    tags = np.random.default_rng(9).integers(0, 2**63, n, np.uint64)
    pattern = np.add.reduceat(tags[owner], starts) if len(starts) else starts
    _, first, weight = np.unique(pattern, return_index=True, return_counts=True)
    out = np.diag([float(len(s)) for s in sets])
    shared = counts[first] > 1
    first, weight = first[shared], weight[shared]
    diagonal = out.diagonal().copy()
    for lo in range(0, len(first), 2048):
        some = first[lo : lo + 2048]
        matrix = np.zeros((n, len(some)), np.float32)
        for c, f in enumerate(some):
            matrix[owner[starts[f] : starts[f] + counts[f]], c] = 1
        out += (matrix * weight[lo : lo + 2048]) @ matrix.T
    np.fill_diagonal(out, diagonal)
    return np.rint(out).astype(np.int64)


def _lowest_linked(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each member the smallest node of its component within the group."""
    peer, seen = nodes.copy(), np.zeros(len(nodes), bool)
    for start in np.argsort(nodes).tolist():
        if seen[start]:
            continue
        seen[start], front = True, linked[start].copy()
        while True:
            new = np.flatnonzero(front & ~seen)
            if not len(new):
                break
            seen[new], peer[new] = True, nodes[start]
            front = linked[new].any(axis=0)
    return peer


def _verified(docs: DataFrame, sketched: DataFrame, clusters: DataFrame, chance, similarity: float) -> DataFrame:
    """Exact links within clusters; each text of a cluster is read once more, for its set."""
    nodes = sketched.join(clusters, "node").groupBy("node", "root").agg(F.min("th").alias("th"), F.count("*").alias("copies"))
    sizes = nodes.groupBy("root").agg(F.count("*").alias("size"))
    wanted = nodes.join(sizes, "root")
    # One row per text: copies do not travel.
    texts = docs.select(text_hash(F.col("text")).alias("th"), "text").join(wanted, "th").dropDuplicates(["node"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch):
                found = [s.tobytes() for s in shingle_sets(part.column("text"))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("root", "node", "copies", "size")], pa.array(found, pa.binary())], ["root", "node", "copies", "size", "shingles"])

    members = texts.select("root", "node", "copies", "size", "text").mapInArrow(sets, "root bigint, node bigint, copies bigint, size bigint, shingles binary")
    split = _parts(members, "root", F.col("size"), CLUSTER_PART)
    n_tasks = max(2 * shuffle_parts(docs.sparkSession), math.ceil(clusters.count() / 5_000))
    return _together(split, ["root", "lo", "hi"], n_tasks, lambda g, cuts: _links(g, cuts, similarity, chance), LINKS)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """``doc_id, th, node, class_id, n_links``: each document's class and number of links.

    Two documents are linked if the Jaccard similarity of their sets of five-word runs is at least
    ``similarity``. A class is a connected component of links; its id is the smallest ``doc_id``
    in it. ``th`` is the text's hash and ``node`` the set's number; documents with equal sets,
    exact copies among them, share a node and are all linked.

    An LSH forest of ``trees`` sorted prefix tries proposes clusters: it starts with prefixes of
    ``depth`` values and shortens them while the recall that the found links' similarities imply
    is below ``recall``. Within a cluster all similarities are computed exactly, part by part, in
    the task; pairs are never rows. Texts shorter than five words are one run.

    Documents without a word, or with null text, are linked to nothing; null ids are left out of
    class ids (a class without any id has a null id); repeated rows count as copies; an empty
    table gives no rows; other columns are ignored.
    """
    docs = documents(docs)
    sketched = told_apart(materialize(_sketched(docs, trees, depth), "sketches"))
    nodes = sketched.filter("node is not null").groupBy("node").agg(F.min("sketch").alias("sketch"))
    prefix = depth
    while True:

        def chance(s, prefix=prefix):
            return collision_chance(s, trees, prefix)

        clusters = candidate_clusters(nodes, trees, depth, prefix)
        links = materialize(_verified(docs, sketched.drop("sketch"), clusters, chance, similarity), "links")
        found = links.agg(F.sum("pairs").alias("n"), F.sum("expected").alias("hits"), F.max("cut").alias("cut")).first()
        if prefix == 1 or not found["n"] or found["hits"] / found["n"] >= recall:
            break
        prefix -= 1
    edges = links.select(F.col("node").alias("a"), F.col("peer").alias("b")).filter("a <> b").distinct()
    # Clusters that one task saw whole have their components already.
    roots = components(edges, "classes") if found["cut"] else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    counts = links.groupBy("node").agg(F.sum("links").alias("near"))
    own = sketched.drop("sketch").filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classed = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(counts, "node", "left")
    ids = classed.groupBy("root").agg(F.min("least").alias("class_id"))
    per_node = classed.join(ids, "root").select("node", "class_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    joined = sketched.select("doc_id", "th", "node").join(per_node, "node", "left")
    alone = F.col("node").isNull()
    return joined.select("doc_id", "th", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near duplicates: of each class the one with the smallest id stays.

    Of repeated rows one stays; documents without a word, or with null text, all stay. Columns are
    kept, whatever their names; an empty table gives no rows.
    """
    found = near_duplicates(docs, similarity)
    first = found.filter("node is not null").groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("node")).alias("own")).agg(F.min(F.struct("doc_id", "th")).alias("first"))
    stay = first.select("first.doc_id", "first.th").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The caller's columns travel as one, so that no name of theirs meets one of the operator's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"), text.alias("words"))
    wordless = ~F.exists(F.split("words", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    keyed = rows.withColumn("key", text_hash(F.col("words"))).drop("words")
    joined = keyed.join(stay, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("th")), "left_semi")
    kept = joined.dropDuplicates(["id", "key"]).select("row").unionByName(rows.filter(wordless).select("row"))
    return kept.select("row.*")
