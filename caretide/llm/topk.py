"""Exact top-k search by inner product, with candidates eliminated by a table of pivot distances."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretide.session import materialize

SCALE = 1024
PIVOTS = 32
#: Vectors from which pivots are chosen, and lengths of vectors that get pivots.
SAMPLE, LENGTHS = 2_048, 16
CANDIDATE_ROWS, QUERY_ROWS = 4_096, 8_192
STEP = 256

FOUND = "query_id bigint, query_row bigint, times bigint, vec_id bigint, score bigint"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v ARRAY<BIGINT>, copies``: components times ``scale``, rounded down, and how many rows
    have this id and vector; unusable vectors are left out."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the sampled vector farthest from those before it."""
    if not len(sample):
        return sample
    rows = [0]
    near = np.linalg.norm(sample - sample[0], axis=1)
    while len(rows) < min(count, len(sample)) and near.max() > 0:
        rows.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[rows[-1]], axis=1))
    return sample[rows]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks] or [np.empty(0, np.int64)])
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scores(rows: np.ndarray, query: np.ndarray, exact_in_float: bool) -> np.ndarray:
    if exact_in_float:
        return (rows.astype(float) @ query.astype(float)).astype(np.int64)
    scores = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in rows.tolist()]
    return np.array(scores, np.int64)  # raises if a score is no 64-bit integer


def search_block(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Each query's ``k`` best rows of a block: bounds first, then candidates in the order of their bounds.

    By the triangle inequality |q - x| is at least the largest |d(q, p) - d(x, p)| over the pivots
    p, so q.x is at most (|q|^2 + |x|^2 - that^2) / 2. Once the next bound is below the k-th best
    score, no later candidate can enter.
    """
    out: list[tuple[np.ndarray, ...]] = []
    ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"))
    copies, numbers = rows.column("copies").to_numpy(), rows.column("row").to_numpy()
    qids, q = queries.column("vec_id").to_numpy(), _matrix(queries.column("v"))
    qrows, times = queries.column("row").to_numpy(), queries.column("copies").to_numpy()
    dx, dq = _matrix(rows.column("far")), _matrix(queries.column("far"))
    if len(ids) and len(qids):
        order = np.argsort(ids, kind="stable")
        ids, x, dx, copies, numbers = ids[order], x[order], dx[order], copies[order], numbers[order]
        norm = (x.astype(float) ** 2).sum(1)
        largest = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * max(x.shape[1], 1)
        for i, qid in enumerate(qids):
            own = (q[i].astype(float) ** 2).sum()
            gap = np.abs(dx - dq[i]).max(axis=1, initial=0)
            slack = 1.0 + 1e-9 * (norm + own)  # for rounding
            bound = (norm + own - gap * gap) / 2 + slack
            held = np.where(numbers == qrows[i], copies - 1, copies)  # the query's own row is no candidate
            bound[held == 0] = -np.inf
            best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
            turn = np.argsort(-bound, kind="stable")[: int((bound > -np.inf).sum())]
            for lo in range(0, len(turn), STEP):
                if len(best) == k and bound[turn[lo]] < best[-1]:
                    break
                some = turn[lo : lo + STEP]
                each = np.minimum(held[some], k)
                best = np.concatenate([best, np.repeat(_scores(x[some], q[i], largest < 2**53), each)])
                best_ids = np.concatenate([best_ids, np.repeat(ids[some], each)])
                top = np.lexsort((best_ids, -best.astype(object) if largest >= 2**53 else -best))[:k]
                best, best_ids = best[top], best_ids[top]
            n = len(best)
            out.append((np.full(n, qid), np.full(n, qrows[i]), np.full(n, times[i]), best_ids, best))
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def exact_top_k(embeddings: DataFrame, is_query, k: int = 10, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows by integer inner product.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows but the query's own. Ties go
    to the smaller ``vec_id``; a query with fewer candidates gets all. Rows are dealt out to
    candidate blocks and query blocks of bounded size by a hash of their id; each pair of blocks
    is searched in one task, by :func:`search_block`, and gives at most ``k`` rows per query.

    Pivots are chosen from a bounded sample (2,048 rows with the smallest id hashes, at most 16
    vector lengths) and broadcast; every row's distances to them are computed once. A vector
    length without pivots is searched in full.

    Vectors that are null or hold null or non-finite components, and rows without id, take no
    part. Rows that share an id are rows of their own: each is a candidate, also of the others,
    and each that is a query has its own ranks; equal ones are searched once. Vectors of different
    lengths are no candidates of each other. A score that is no 64-bit integer fails. An empty table gives no
    rows; other columns are ignored.
    """
    vectors = materialize(integer_vectors(embeddings, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    counts = vectors.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").take(SAMPLE)
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    lengths = sorted(by_length, key=lambda n: -len(by_length[n]))[:LENGTHS]
    chosen = {n: choose_pivots(np.array(by_length[n], float).reshape(-1, n), pivots) for n in lengths}
    n_rows, n_queries = math.ceil(counts["rows"] / CANDIDATE_ROWS), math.ceil(counts["queries"] / QUERY_ROWS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = []
            for v in batch.column("v").to_pylist():
                near = chosen.get(len(v))
                far.append([] if near is None else np.linalg.norm(near - np.array(v, float), axis=1).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far, pa.list_(pa.float64()))], [*batch.schema.names, "far"])

    def block(n: int):
        return F.pmod(F.xxhash64("vec_id", "row", F.lit(1)), F.lit(max(n, 1)))

    table = vectors.mapInArrow(measure, "vec_id bigint, v array<bigint>, copies bigint, row bigint, far array<double>").withColumn("length", F.size("v"))
    candidates = table.withColumn("row_block", block(n_rows)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_queries, 1) - 1)).cast("array<bigint>")))
    queries = table.filter(is_query).withColumn("query_block", block(n_queries)).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(max(n_rows, 1) - 1)).cast("array<bigint>")))
    keys = ("length", "row_block", "query_block")
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(lambda q, x: search_block(q, x, k), FOUND)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
