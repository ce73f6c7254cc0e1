"""Exact quantiles at any size, without collecting or sorting a column.

A sketch over some of the rows gives a narrow bracket around each wanted rank;
counting all rows below and at the bracket's ends then tells exactly where the rank
lies. A rank on an end is done; one strictly between is looked up if few rows are
left there, else the search goes on inside. The sketch only guides the search: a
bracket that misses costs a round, never the result. Every pass is one aggregation
over all columns, and what crosses the network does not grow with the table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.operators.schema import col
from caretide.session import materialize, measured_side

_AGGREGATES_PER_JOB = 200


@dataclass
class _Rank:
    """Search state of one order statistic: it lies strictly in (lo, hi)."""

    column: str
    rank: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    value: float | None = None


def _aggregate(df: DataFrame, aggregates: Sequence) -> list:
    """Results of many aggregates, in bounded batches so generated code stays small."""
    out: list = []
    for start in range(0, len(aggregates), _AGGREGATES_PER_JOB):
        batch = aggregates[start : start + _AGGREGATES_PER_JOB]
        row: Row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(batch)]).first()
        out.extend(row)
    return out


def _between(c, lo: float | None, hi: float | None):
    inside = c.isNotNull()
    if lo is not None:
        inside = inside & (c > F.lit(lo))
    if hi is not None:
        inside = inside & (c < F.lit(hi))
    return inside


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    *,
    sketch_rows: int = 500_000,
    accuracy: int = 10_000,
    lookup_rows: int = 100_000,
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles, ``{column: {p: value}}``; null if no data.

    NaN and NULL are left out. ``sketch_rows`` and ``accuracy`` size a sketch and
    ``lookup_rows`` is the most rows of one bracket that are ever gathered; none of
    them changes the result.
    """
    if accuracy < 100 or sketch_rows < 1000 or lookup_rows < 1:
        raise ValueError("accuracy and sketch_rows must be at least 100 and 1000")
    names = list(wanted)
    view = df.select(*[finite(col(n)).alias(f"c{i}") for i, n in enumerate(names)])
    c = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    got = _aggregate(view, [f(c[n]) for n in names for f in (F.count, F.min, F.max)])

    total: dict[str, int] = {}
    ranks: dict[tuple[str, int], _Rank] = {}
    for i, n in enumerate(names):
        total[n], least, most = got[3 * i : 3 * i + 3]
        if not total[n]:
            continue
        last = total[n] - 1
        ranks[n, 0], ranks[n, last] = _Rank(n, 0, value=least), _Rank(n, last, value=most)
        for p in wanted[n]:
            for r in (math.floor(p * last), math.ceil(p * last)):
                if (n, r) not in ranks:
                    value = least if least == most else None
                    ranks[n, r] = _Rank(n, r, inside=total[n], value=value)

    seed = 0
    while todo := [r for r in ranks.values() if r.value is None]:
        _lookup_round(view, c, [r for r in todo if r.inside <= lookup_rows])
        todo = [r for r in todo if r.value is None]
        if todo:
            brackets = _sketch_round(view, c, todo, sketch_rows, accuracy, seed)
            _count_round(view, c, [r for r in todo if (r.column, r.rank) in brackets], brackets)
        seed += 1

    out: dict[str, dict[float, float | None]] = {}
    for n in names:
        out[n] = {}
        for p in wanted[n]:
            if not total[n]:
                out[n][p] = None
                continue
            at = p * (total[n] - 1)
            low, high = ranks[n, math.floor(at)].value, ranks[n, math.ceil(at)].value
            share = at - math.floor(at)
            if low == high:  # infinite values too, whose difference is no number
                out[n][p] = low
            else:
                out[n][p] = low + (high - low) * share if share < 0.5 else high - (high - low) * (1.0 - share)
    return out


def _by_interval(ranks: Sequence[_Rank]) -> dict[tuple, list[_Rank]]:
    """Ranks that share a column and an open interval share the work on it."""
    groups: dict[tuple, list[_Rank]] = {}
    for r in sorted(ranks, key=lambda r: r.rank):
        groups.setdefault((r.column, r.lo, r.hi), []).append(r)
    return groups


def _sketch_round(view, c, todo, sketch_rows, accuracy, seed) -> dict:
    """A bracket per rank from a sketch over about ``sketch_rows`` rows of its interval."""
    drawn = view.withColumn("u", F.rand(seed))
    groups = _by_interval(todo)
    aggregates = []
    for (n, lo, hi), ranks in groups.items():
        inside = ranks[0].inside
        share = min(1.0, sketch_rows / inside)
        # Five standard errors of a drawn rank, and the error of the sketch.
        margin = 2.0 / accuracy + (2.5 / math.sqrt(sketch_rows) if share < 1.0 else 0.0)
        asked = []
        for r in ranks:
            at = (r.rank - r.below) / max(1, inside - 1)
            asked += [max(0.0, at - margin), min(1.0, at + margin)]
        taken = _between(c[n], lo, hi)
        if share < 1.0:
            taken = taken & (F.col("u") < F.lit(share))
        aggregates.append(F.percentile_approx(F.when(taken, c[n]), asked, accuracy))
    brackets = {}
    for ranks, got in zip(groups.values(), _aggregate(drawn, aggregates), strict=True):
        for i, r in enumerate(ranks if got else ()):
            brackets[r.column, r.rank] = (got[2 * i], got[2 * i + 1])
    return brackets


def _count_round(view, c, todo, brackets) -> None:
    """Place each rank below, on, between or above the ends of its bracket."""
    ends = sorted({(r.column, e) for r in todo for e in brackets[r.column, r.rank]})
    aggregates = []
    for n, e in ends:
        aggregates += [F.count_if(c[n] < F.lit(e)), F.count_if(c[n] <= F.lit(e))]
    got = _aggregate(view, aggregates)
    counts = {end: (got[2 * i], got[2 * i + 1]) for i, end in enumerate(ends)}
    for r in todo:
        a, b = brackets[r.column, r.rank]
        under_a, upto_a = counts[r.column, a]
        under_b, upto_b = counts[r.column, b]
        if under_a <= r.rank < upto_a:
            r.value = a
        elif under_b <= r.rank < upto_b:
            r.value = b
        elif r.rank < under_a:
            r.hi, r.inside = a, under_a - r.below
        elif r.rank >= upto_b:
            r.inside -= upto_b - r.below
            r.lo, r.below = b, upto_b
        else:
            r.lo, r.hi, r.below, r.inside = a, b, upto_a, under_b - upto_a


def _lookup_round(view, c, short) -> None:
    """Pick ranks out of intervals known to hold few rows."""
    groups = _by_interval(short)
    if not groups:
        return
    aggregates = []
    for (n, lo, hi), ranks in groups.items():
        rows = F.sort_array(F.collect_list(F.when(_between(c[n], lo, hi), c[n])))
        aggregates.append(F.array(*[F.get(rows, F.lit(r.rank - r.below)) for r in ranks]))
    for ranks, got in zip(groups.values(), _aggregate(view, aggregates), strict=True):
        for r, value in zip(ranks, got, strict=True):
            r.value = value


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    grid: int = 512,
    lookup_rows: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles of every group, as rows ``(*by, p, value)``.

    The search of ``exact_quantiles`` for all groups at once: the brackets are rows of a
    table with one row per group, joined to the data by group (broadcast only if measured
    small), so any number of groups takes the same few rounds and a hot group is combined
    in the map tasks. ``grid`` points of a sketch narrow a bracket, ``lookup_rows`` is the
    most rows of one bracket that are ever gathered; neither changes the result.

    NaN and NULL are left out, a group without other values has null quantiles, a null
    group is a group of its own, an empty table gives no rows.
    """
    if grid < 8 or lookup_rows < 1 or not by or not all(0.0 <= p <= 1.0 for p in probs):
        raise ValueError("grid from 8, lookup_rows from 1, a group column and probabilities in [0, 1]")
    keys = [f"g{i}" for i in range(len(by))]
    view = df.select(*[col(n).alias(k) for n, k in zip(by, keys, strict=True)], finite(col(value)).alias("v"))
    asked = list(dict.fromkeys(float(p) for p in probs))
    ends = [(p, round_) for p in asked if 0.0 < p < 1.0 for round_ in (F.floor, F.ceil)]
    several = range(len(ends))

    total = view.groupBy(*keys).agg(F.count("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most"))
    state = [F.col(k) for k in (*keys, "total", "least", "most")]
    for i, (p, round_) in enumerate(ends):
        rank = round_(F.lit(p) * (F.col("total") - 1)).cast("bigint")
        known = (
            F.when((rank == 0) | (F.col("least") == F.col("most")), F.col("least"))
            .when(rank == F.col("total") - 1, F.col("most"))
        )
        state += [
            rank.alias(f"rank{i}"), F.lit(None).cast("double").alias(f"lo{i}"), F.lit(None).cast("double").alias(f"hi{i}"),
            F.lit(0).cast("bigint").alias(f"below{i}"), F.col("total").alias(f"inside{i}"), known.alias(f"value{i}"),
        ]
    ranks = materialize(total.select(*state), "quantile-groups")
    still_open = reduce(or_, [(F.col("total") > 0) & F.col(f"value{i}").isNull() for i in several], F.lit(False))

    if not ranks.filter(still_open).isEmpty():
        ranks = _whole_groups(view, keys, ranks, still_open, several, lookup_rows)
    first = True
    while not ranks.filter(still_open).isEmpty():
        ranks = _narrow(view, keys, ranks, still_open, several, grid, lookup_rows, first)
        first = False

    rows, inner = [], [p for p in asked if 0.0 < p < 1.0]
    for p in asked:
        if p in inner:
            low, high = F.col(f"value{2 * inner.index(p)}"), F.col(f"value{2 * inner.index(p) + 1}")
        else:
            low = high = F.col("most" if p else "least")
        at = F.lit(float(p)) * (F.col("total") - 1)
        share = at - F.floor(at)
        between = F.when(share < 0.5, low + (high - low) * share).otherwise(high - (high - low) * (1.0 - share))
        rows.append(F.struct(F.lit(float(p)).alias("p"), F.when(low == high, low).otherwise(between).alias("value")))
    out = ranks.select(*keys, F.explode(F.array(*rows)).alias("q"))
    return out.select(*[F.col(k).alias(n) for k, n in zip(keys, by, strict=True)], "q.p", "q.value")


def _with_rows(view, keys, side: DataFrame):
    """The values of the groups of ``side``, each with its group's row, grouped."""
    side = measured_side(side, "quantile-brackets").withColumnsRenamed({k: f"of_{k}" for k in keys})
    return view.filter("v is not null").join(side, _same(keys)).groupBy(*keys)


def _rejoined(keys, state: DataFrame, found: DataFrame) -> DataFrame:
    found = found.withColumnsRenamed({k: f"of_{k}" for k in keys})
    return state.join(found, _same(keys), "left").drop(*[f"of_{k}" for k in keys])


def _same(keys):
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])


def _whole_groups(view, keys, ranks, still_open, several, lookup_rows) -> DataFrame:
    """Groups known to hold few values are sorted as they are, each once."""
    small = ranks.filter(still_open & (F.col("total") <= lookup_rows))
    listed = F.sort_array(F.collect_list("v"))
    found = _with_rows(view, keys, small).agg(
        *[F.get(listed, F.any_value(f"rank{i}").cast("int")).alias(f"found{i}") for i in several]
    )
    values = {f"value{i}": F.coalesce(f"value{i}", f"found{i}") for i in several}
    ranks = _rejoined(keys, ranks, found).withColumns(values).drop(*[f"found{i}" for i in several])
    return materialize(ranks, "quantile-groups")


def _narrow(view, keys, ranks, still_open, several, grid, lookup_rows, first) -> DataFrame:
    """One round over all groups: look up short brackets, narrow the others."""
    v = F.col("v")
    points = [j / grid for j in range(grid + 1)]
    sought = []
    for i in several:
        lo, hi, unknown = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"value{i}").isNull()
        taken = unknown & (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))
        short = F.col(f"inside{i}") <= lookup_rows
        listed = F.sort_array(F.collect_list(F.when(taken & short, v)))
        at = F.any_value(F.col(f"rank{i}") - F.col(f"below{i}")).cast("int")
        sought.append(F.get(listed, at).alias(f"found{i}"))
        # At first all ranks of a group share one bracket, and so one sketch.
        sketch = F.percentile_approx(v if first else F.when(taken & ~short, v), points, 20 * grid)
        share = F.any_value((F.col(f"rank{i}") - F.col(f"below{i}")) / F.greatest(F.col(f"inside{i}") - 1, F.lit(1)))
        sought.append(F.get(sketch, F.greatest(F.floor(share * grid) - 1, F.lit(0)).cast("int")).alias(f"a{i}"))
        sought.append(F.get(sketch, F.least(F.ceil(share * grid) + 1, F.lit(grid)).cast("int")).alias(f"b{i}"))
    ranks = _rejoined(keys, ranks, _with_rows(view, keys, ranks.filter(still_open)).agg(*sought))
    values = {f"value{i}": F.coalesce(f"value{i}", f"found{i}") for i in several}
    ranks = ranks.withColumns(values).drop(*[f"found{i}" for i in several])
    ranks = materialize(ranks, "quantile-brackets")
    if ranks.filter(still_open).isEmpty():
        return ranks

    counted = [
        F.count_if(test).alias(f"{name}{e}{i}")
        for i in several
        for e in "ab"
        for name, test in (("under_", v < F.col(f"{e}{i}")), ("upto_", v <= F.col(f"{e}{i}")))
    ]
    ranks = _rejoined(keys, ranks, _with_rows(view, keys, ranks.filter(still_open)).agg(*counted))
    kept = [F.col(k) for k in (*keys, "total", "least", "most")]
    for i in several:
        c = {n: F.col(f"{n}{i}") for n in ("rank", "lo", "hi", "below", "inside", "value", "a", "b")}
        under_a, upto_a, under_b, upto_b = (F.col(f"{n}{i}") for n in ("under_a", "upto_a", "under_b", "upto_b"))
        on_a, on_b = (under_a <= c["rank"]) & (c["rank"] < upto_a), (under_b <= c["rank"]) & (c["rank"] < upto_b)
        before, after, stays = c["rank"] < under_a, c["rank"] >= upto_b, c["value"].isNotNull() | c["a"].isNull()
        kept += [
            c["rank"],
            F.when(stays | before, c["lo"]).when(after, c["b"]).otherwise(c["a"]).alias(f"lo{i}"),
            F.when(stays | after, c["hi"]).when(before, c["a"]).otherwise(c["b"]).alias(f"hi{i}"),
            F.when(stays | before, c["below"]).when(after, upto_b).otherwise(upto_a).alias(f"below{i}"),
            F.when(stays, c["inside"]).when(before, under_a - c["below"])
            .when(after, c["inside"] - (upto_b - c["below"])).otherwise(under_b - upto_a).alias(f"inside{i}"),
            F.coalesce(c["value"], F.when(on_a, c["a"]).when(on_b, c["b"])).alias(f"value{i}"),
        ]
    return materialize(ranks.select(*kept), "quantile-groups")


def approx_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], accuracy: int = 10_000
) -> dict[str, dict[float, float | None]]:
    """Sketch quantiles in one pass: an actual value of rank within n / accuracy."""
    names = list(wanted)
    aggregates = [
        F.percentile_approx(finite(col(n)), [float(p) for p in wanted[n]], accuracy) for n in names
    ]
    got = _aggregate(df, aggregates)
    return {
        n: dict(zip(wanted[n], got[i] or [None] * len(wanted[n]), strict=True))
        for i, n in enumerate(names)
    }


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], method: str = "exact"):
    """``exact`` or ``approx`` quantiles."""
    if method == "exact":
        return exact_quantiles(df, wanted)
    if method == "approx":
        return approx_quantiles(df, wanted)
    raise ValueError(f"unknown method: {method}")


def quantile_table(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], method: str = "exact"
) -> DataFrame:
    """Long form ``(column, p, value)``."""
    got = quantiles(df, {n: probs for n in columns}, method)
    rows = [(n, float(p), got[n][p]) for n in columns for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
