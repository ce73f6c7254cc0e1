"""Concordant minus discordant pairs without comparing all pairs.

Values are cut into buckets, a frequent value forming a bucket of its own. With
S the score of a set of points,

    S(all) = S(bucket grid) + sum S(x bucket) + sum S(y bucket) - sum S(cell)

because two points in different x and y buckets are ordered as their buckets are,
and points that share a bucket are counted inside it (twice if they share both).
The inside scores are merge counts of bounded groups; the grid is again a set of
weighted points, far fewer of them, and is treated the same way until it is small.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.session import materialize

_SCORE = "score decimal(38,0)"


@dataclass
class KendallCounts:
    """Score and tie sums; ties are over ``t`` copies of one value."""

    n: int
    score: int
    x_ties: int  # sum t(t-1)/2
    y_ties: int
    x_ties2: float  # sum t(t-1)(2t+5)
    y_ties2: float
    x_ties3: float  # sum t(t-1)(t-2)
    y_ties3: float


def _merge_score(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> int:
    """Weighted score of the points of one group in O(m log m) array steps.

    Points are sorted by x and halves of growing size merged: a pair lies in
    different halves at exactly one level. Equal x values get the same rank and
    so fall to one side only through the tie rule below.
    """
    if len(x) < 2:
        return 0
    _, xr = np.unique(x, return_inverse=True)
    _, yr = np.unique(y, return_inverse=True)
    order = np.argsort(yr, kind="stable")
    xr, yr, n = xr[order], yr[order], n[order]
    # Whole numbers of any size where products could pass 64 bits.
    weight = n.astype(np.int64) if float(n.sum()) < 2.0**31 else n.astype(object)
    score = 0
    level = 0
    top = int(xr.max()) if len(xr) else 0
    while (1 << level) <= top:
        # Split each block of 2^(level+1) consecutive x ranks into its two halves.
        block = xr >> (level + 1)
        high = (xr >> level) & 1
        by = np.lexsort((yr, block))
        b, h, yy, w = block[by], high[by], yr[by], weight[by]
        low_w = np.where(h == 0, w, 0)
        upto = np.cumsum(low_w)
        starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        ends = np.r_[starts[1:], len(b)] - 1
        size = np.diff(np.r_[starts, len(b)])
        base = np.repeat(upto[starts] - low_w[starts], size)
        total = np.repeat(upto[ends], size) - base
        tie_starts = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (yy[1:] != yy[:-1])])
        tie_ends = np.r_[tie_starts[1:], len(b)] - 1
        tie_size = np.diff(np.r_[tie_starts, len(b)])
        below = np.repeat(upto[tie_starts] - low_w[tie_starts], tie_size) - base
        through = np.repeat(upto[tie_ends], tie_size) - base
        above = total - through
        gain = np.where(h == 1, w * (below - above), 0)
        score += int(gain.sum())
        level += 1
    return score


def _group_score(pdf: pd.DataFrame) -> pd.DataFrame:
    from decimal import Decimal

    value = _merge_score(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame({"score": [Decimal(value)]})


def _cuts(points: DataFrame, size: int, column: str, buckets: int) -> list[float]:
    """Values at about equal steps of rank; a frequent value appears among them.

    Any cuts give the right score. Those of some hundred drawn points per bucket
    make the buckets about equally large.
    """
    share = min(1.0, 100.0 * buckets / size)
    drawn = points if share == 1.0 else points.sample(share, seed=7)
    steps = [i / buckets for i in range(1, buckets)]
    got = drawn.agg(F.percentile_approx(column, steps, max(10_000, 20 * buckets))).first()[0]
    return sorted(set(got or []))


def _bucketed(points: DataFrame, column: str, cuts: list[float], into: str) -> DataFrame:
    """2i for the i-th cut value itself and 2i + 1 above it, so a cut stands alone."""
    if not cuts:
        return points.withColumn(into, F.lit(1))
    splits = [-math.inf, *cuts, math.inf]
    placed = Bucketizer(splits=splits, inputCol=column, outputCol="__i").transform(points)
    at = F.col("__i").cast("int")
    bounds = F.array(*[F.lit(v) for v in cuts])
    on_cut = F.coalesce(F.get(bounds, at - 1) == F.col(column), F.lit(False))
    return placed.withColumn(into, at * 2 + F.when(on_cut, 0).otherwise(1)).drop("__i")


def _inside(points: DataFrame, keys: list[str]) -> int:
    """Sum of the scores inside the groups of ``keys``; odd codes mark open buckets.

    A group whose key contains a cut value has one x (or one y) and scores 0.
    """
    open_only = points
    for k in keys:
        open_only = open_only.filter(F.col(k) % 2 == 1)
    total = open_only.groupBy(*keys).applyInPandas(_group_score, _SCORE).agg(F.sum("score")).first()[0]
    return int(total or 0)


def _score(points: DataFrame, size: int, small: int) -> int:
    if size <= small:
        one = points.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(_group_score, _SCORE).first()
        return int(one[0]) if one else 0
    buckets = max(4, math.isqrt(size) // 10)
    cut = {c: _cuts(points, size, c, buckets) for c in ("x", "y")}
    coded = _bucketed(_bucketed(points, "x", cut["x"], "bx"), "y", cut["y"], "by")
    placed = materialize(coded, "kendall")
    grid = materialize(
        placed.groupBy("bx", "by")
        .agg(F.sum("n").alias("n"))
        .select(F.col("bx").cast("double").alias("x"), F.col("by").cast("double").alias("y"), "n"),
        "grid",
    )
    inside = _inside(placed, ["bx"]) + _inside(placed, ["by"]) - _inside(placed, ["bx", "by"])
    left = grid.count()
    # A grid that stops shrinking is small in one direction: count it at once.
    return inside + _score(grid, left, small if left < size else left)


def _ties(pairs: DataFrame, column: str):
    t = F.col("t")
    d = t.cast("double")
    exact = t.cast("decimal(19,0)")
    row = (
        pairs.groupBy(column)
        .agg(F.sum("n").alias("t"))
        .agg(
            F.sum(exact * (exact - 1)),
            F.sum(d * (d - 1) * (2 * d + 5)),
            F.sum(d * (d - 1) * (d - 2)),
        )
        .first()
    )
    return int(row[0] or 0) // 2, row[1] or 0.0, row[2] or 0.0


def kendall_counts(pairs: DataFrame, small: int = 200_000) -> KendallCounts:
    """Counts for tau-b from distinct ``(x, y, n)`` points.

    ``small`` is the number of points that one group may hold at the last step.
    """
    n, size = pairs.agg(F.sum("n"), F.count(F.lit(1))).first()
    x1, x2, x3 = _ties(pairs, "x")
    y1, y2, y3 = _ties(pairs, "y")
    score = _score(pairs, size, small) if size else 0
    return KendallCounts(n or 0, score, x1, y1, x2, y2, x3, y3)
