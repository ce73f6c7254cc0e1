"""Exploration: counts, summaries, distributions, correlations and dashboards."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.operators.quality import agg_to_rows
from caretide.operators.quantiles import exact_quantiles
from caretide.operators.schema import col, numeric_columns
from caretide.session import materialize

#: Of a pair of columns, over rows where both are present: count, means, moments about them, ranges.
_PAIR_STATS = ("n", "mx", "my", "sxx", "syy", "sxy", "lo_x", "lo_y", "hi_x", "hi_y")
#: Pairs of columns correlated by one native aggregation; the code of a larger one is slow to compile.
PAIRS_PER_PASS = 24


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` without nulls, most frequent first, ties by value."""
    return (
        df.filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
    )


def value_share(df: DataFrame, column: str) -> DataFrame:
    """``value_counts`` with the percentage of all non-null rows."""
    counts = value_counts(df, column)
    total = df.agg(F.count(col(column)).cast("double")).scalar()
    return counts.select("value", "n", (F.col("n") * 100 / total).alias("pct"))


def day_of_week_counts(df: DataFrame, column: str = "day_of_week") -> DataFrame:
    """Rows per weekday 0..6; a day without rows shows 0."""
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    counts = df.groupBy(col(column).cast("int").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        days.join(counts.filter("day_of_week is not null"), "day_of_week", "left")
        .select("day_of_week", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("day_of_week")
    )


def engagement_totals(df: DataFrame, columns: Sequence[str] = ("likes", "retweets")) -> DataFrame:
    return df.agg(*[F.sum(col(c)).cast("bigint").alias(f"total_{c}") for c in columns])


def flag_total(df: DataFrame, column: str) -> DataFrame:
    """Rows whose flag (boolean or 0/1) is set."""
    return df.agg(F.count_if(col(column).cast("boolean")).alias("n"))


def top_terms(df: DataFrame, column: str, k: int = 10, none: str = "none") -> DataFrame:
    """Most frequent entries of a ``', '``-joined list column."""
    return (
        df.select(F.explode(F.split(col(column), ", ")).alias("term"))
        .filter(F.col("term") != none)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("term"))
        .limit(k)
    )


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """First ``k`` rows by descending value; Spark keeps ``k`` rows per task."""
    return df.orderBy(col(by).desc(), col(tie).asc()).limit(k)


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std, min, quartiles, max, missing."""
    names = list(columns) if columns is not None else numeric_columns(df)
    quartiles = exact_quantiles(df, {n: [0.25, 0.5, 0.75] for n in names})
    rows = F.count(F.lit(1))
    entries = {}
    for n in names:
        value = finite(col(n))
        missing = F.count_if(value.isNull())
        entries[n] = {
            "count": F.count(value),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
            "missing": missing,
            "missing_pct": F.try_divide(missing.cast("double"), rows) * 100,
            **{
                f"p{round(p * 100)}": F.max(F.lit(quartiles[n][p]).cast("double"))
                for p in (0.25, 0.5, 0.75)
            },
        }
    metrics = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "missing", "missing_pct"]
    wide = agg_to_rows(df, entries, ("column", "metric")).groupBy("column").pivot("metric", metrics)
    out = wide.agg(F.first("value"))
    return out.withColumns({m: F.col(m).cast("bigint") for m in ("count", "missing")})


def _shape(value: Column) -> dict[str, Column]:
    """Bias-corrected skewness and excess kurtosis of one column.

    A constant column gives 0; fewer than 3 (4) values give null.
    """
    n = F.count(value).cast("double")
    flat = F.min(value) == F.max(value)  # rounding may leave a deviation
    g1 = F.when(flat, 0.0).otherwise(F.skewness(value))
    g2 = F.when(flat, 0.0).otherwise(F.kurtosis(value))
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = F.when(flat, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return {
        "skewness": F.when(n >= 3, skew),
        "kurtosis": F.when(n >= 4, kurt),
    }


def distribution_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, metric, value)``: mean, median, std, skewness, kurtosis, min, max."""
    names = [n for n in columns if n in df.columns]
    middle = exact_quantiles(df, {n: [0.5] for n in names})
    entries = {}
    for n in names:
        value = finite(col(n))
        entries[n] = {
            "mean": F.avg(value),
            "median": F.max(F.lit(middle[n][0.5]).cast("double")),
            "std": F.stddev_samp(value),
            **_shape(value),
            "min": F.min(value),
            "max": F.max(value),
        }
    return agg_to_rows(df, entries, ("column", "metric"))


def pearson(a: Column, b: Column, gaps: bool = True) -> Column:
    """Pearson r over rows where both values are present; null if one is constant or infinite.

    Without ``gaps`` both are present in every row, so that what is computed of one column is
    shared by all its pairs.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = (F.when(both, a), F.when(both, b)) if gaps else (a, b)
    # Tested on the values: rounding may leave a constant a deviation.
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(varies & ~F.isnan(r), r)


def correlations(df: DataFrame, columns: Sequence[str] | None = None, pairs_per_pass: int = PAIRS_PER_PASS) -> DataFrame:
    """``(var1, var2, correlation)`` for every pair of numeric columns, over rows where both are present.

    Up to ``pairs_per_pass`` pairs are one native aggregation. More pairs are added up by arrays,
    in one scan whatever their number. Either way each pair has its own means and deviations, so
    that a large value beside a gap of the other column does not touch it. A pair with a constant
    column, or with infinite values, has no correlation (null).
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, correlation double")
    view = df.select(*[finite(col(n)).alias(f"c{i}") for i, n in enumerate(names)])
    if len(pairs) <= pairs_per_pass:
        return _by_pair(view, names, pairs)
    labels = F.array(*[F.lit(c) for c in names])
    found = _by_array(view, len(names))
    return found.select(F.get(labels, F.col("i")).alias("var1"), F.get(labels, F.col("j")).alias("var2"), "correlation")


def _by_pair(view: DataFrame, names: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    used = sorted({i for pair in pairs for i in pair})
    missing = view.agg(*[F.count_if(F.col(f"c{i}").isNull()).alias(f"c{i}") for i in used]).first()

    def entry(i: int, j: int) -> Column:
        gaps = bool(missing[f"c{i}"] or missing[f"c{j}"])
        r = pearson(F.col(f"c{i}"), F.col(f"c{j}"), gaps)
        return F.struct(F.lit(names[i]).alias("var1"), F.lit(names[j]).alias("var2"), r.alias("correlation"))

    entries = view.agg(F.array(*[entry(i, j) for i, j in pairs]).alias("pairs"))
    return entries.select(F.inline("pairs"))


def _pair_stats(x: np.ndarray) -> np.ndarray:
    """``_PAIR_STATS`` by pair (first column, then second, rising) of the rows of an array with gaps (NaN)."""
    columns = x.shape[1]
    out = np.zeros((len(_PAIR_STATS), columns, columns))
    here = ~np.isnan(x)
    for i in range(columns - 1):
        rows = here[:, i]
        a, b, both = x[rows, i, None], x[rows, i + 1 :], here[rows, i + 1 :]
        n = both.sum(axis=0)
        mx, my = (np.where(both, v, 0.0).sum(axis=0) / np.maximum(n, 1) for v in (a, b))
        dx, dy = np.where(both, a - mx, 0.0), np.where(both, b - my, 0.0)
        lows = [np.where(both, v, np.inf).min(axis=0, initial=np.inf) for v in (a, b)]
        highs = [np.where(both, v, -np.inf).max(axis=0, initial=-np.inf) for v in (a, b)]
        moments = [(u * v).sum(axis=0) for u, v in ((dx, dx), (dy, dy), (dx, dy))]
        out[:, i, i + 1 :] = [n, mx, my, *moments, *lows, *highs]
    return out[(slice(None), *np.triu_indices(columns, 1))]


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The statistics of two disjoint sets of rows together (Chan, Golub and LeVeque)."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy, weight = b[1] - a[1], b[2] - a[2], a[0] * share
    moments = a[3:6] + b[3:6] + weight * np.array([dx * dx, dy * dy, dx * dy])
    return np.vstack([n, a[1] + dx * share, a[2] + dy * share, moments, np.minimum(a[6:8], b[6:8]), np.maximum(a[8:], b[8:])])


def _by_array(view: DataFrame, size: int) -> DataFrame:
    """``i, j, correlation`` of each pair: statistics of each task, then those of all about common means."""
    first, second = np.triu_indices(size, 1)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(all="ignore"):  # infinite values leave NaN
            stats = _pair_stats(np.empty((0, size)))
            for batch in batches:
                stats = _merged(stats, _pair_stats(batch.to_numpy(dtype=float)))
        yield pd.DataFrame({"i": first, "j": second, **dict(zip(_PAIR_STATS, stats, strict=True))})

    schema = "i int, j int, " + ", ".join(f"{s} double" for s in _PAIR_STATS)
    stats = materialize(view.mapInPandas(add_up, schema).filter("n > 0"), "stats")
    n = F.col("n")
    centres = stats.groupBy("i", "j").agg(*[(F.sum(n * F.col(m)) / F.sum(n)).alias(f"c_{m}") for m in ("mx", "my")])
    dx, dy = F.col("mx") - F.col("c_mx"), F.col("my") - F.col("c_my")
    sums = [F.sum(F.col(s) + n * u * v).alias(s) for s, u, v in (("sxx", dx, dx), ("syy", dy, dy), ("sxy", dx, dy))]
    ranges = [(F.min(f"lo_{v}") < F.max(f"hi_{v}")).alias(f"varies_{v}") for v in "xy"]
    total = stats.join(centres, ["i", "j"]).groupBy("i", "j").agg(*sums, *ranges)
    r = F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy"))
    # Tested on the values: rounding may leave a constant a deviation.
    pairs = view.sparkSession.createDataFrame(pd.DataFrame({"i": first, "j": second}), "i int, j int")
    known = total.select("i", "j", F.when(F.col("varies_x") & F.col("varies_y") & ~F.isnan(r), r).alias("correlation"))
    return pairs.join(known, ["i", "j"], "left")


def strong_correlations(
    df: DataFrame, threshold: float = 0.5, columns: Sequence[str] | None = None
) -> DataFrame:
    """The pairs with ``|r|`` above the threshold."""
    return correlations(df, columns).filter(F.abs("correlation") > threshold)


def hour_weekday_heatmap(visits: DataFrame) -> DataFrame:
    """Visits and high-acuity share per (arrival hour, weekday)."""
    return (
        visits.filter("arrival_hour is not null and day_of_week is not null")
        .groupBy("arrival_hour", "day_of_week")
        .agg(
            F.count(F.lit(1)).alias("visits"),
            F.avg("high_acuity").alias("high_acuity_share"),
        )
    )


def heatmap_grid(visits: DataFrame) -> DataFrame:
    """The heat map as a grid: one row per hour, one column per weekday."""
    counts = hour_weekday_heatmap(visits).groupBy("arrival_hour")
    grid = counts.pivot("day_of_week", list(range(7))).agg(F.first("visits"))
    return grid.select(
        "arrival_hour", *[F.coalesce(F.col(f"`{d}`"), F.lit(0)).alias(f"d{d}") for d in range(7)]
    )


def kpi_panel(visits: DataFrame, day: str = "visit_date", trailing: int = 7) -> DataFrame:
    """Per day: visits, mean of the last days, high-acuity percentage of the week.

    The visits are cut to one row per day first; the window runs over days.
    """
    daily = (
        visits.filter(col(day).isNotNull())
        .groupBy(col(day).cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("visits"), F.sum("high_acuity").alias("acute"))
    )
    week = F.date_trunc("week", F.col("day")).cast("date")
    by_week = Window.partitionBy("week")
    recent = Window.orderBy("day").rowsBetween(1 - trailing, 0)
    return daily.withColumn("week", week).select(
        "day",
        "visits",
        F.avg("visits").over(recent).alias("trailing_mean"),
        "week",
        (
            F.sum("acute").over(by_week).cast("double") * 100 / F.sum("visits").over(by_week)
        ).alias("high_acuity_pct_week"),
    )


def demographic_breakdown(
    visits: DataFrame, columns: Sequence[str] = ("age_group", "has_insurance")
) -> DataFrame:
    """Visits for every combination of the columns and their totals (cube).

    ``level`` is the grouping id: 0 for full combinations, bits set where a column
    is summed over.
    """
    return visits.cube(*[col(c) for c in columns]).agg(
        F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("visits")
    )


def peak_uplift(
    visits: DataFrame, weekday: int = 0, hours: tuple[int, int] = (18, 20), day: str = "visit_date"
) -> DataFrame:
    """Percent by which visits per hour in a weekly window exceed the overall rate.

    The rate of the window is its visits over its hours on the calendar days of that
    weekday that have visits; the baseline is all visits over all hours of all days.
    """
    seen = visits.filter(col(day).isNotNull() & F.col("arrival_hour").isNotNull())
    per_day = seen.groupBy(col(day).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("arrival_hour").between(*hours)).alias("in_hours"),
    )
    on_day = F.weekday("day") == weekday
    width = hours[1] - hours[0] + 1
    one = per_day.agg(
        F.sum("n").alias("visits"),
        F.count(F.lit(1)).alias("days"),
        F.coalesce(F.sum(F.when(on_day, F.col("in_hours"))), F.lit(0)).alias("window_visits"),
        F.count_if(on_day).alias("window_days"),
    )
    rate = F.try_divide(F.col("window_visits").cast("double"), F.col("window_days") * width)
    base = F.try_divide(F.col("visits").cast("double"), F.col("days") * 24)
    return one.select(
        "window_visits",
        rate.alias("window_rate"),
        base.alias("base_rate"),
        ((F.try_divide(rate, base) - 1) * 100).alias("uplift_pct"),
    )
