"""Data-quality reports in long form ``(check, column, metric, value)``.

All columns of a check are computed together: one aggregation or one grouped
pass per check, never one scan per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.functions.dates import parse_date
from caretide.operators.cleaning import fences
from caretide.operators.quantiles import exact_quantiles
from caretide.operators.schema import col, is_missing, numeric_columns, string_columns

_PER_JOB = 400


def agg_to_rows(
    df: DataFrame, entries: Mapping[str, Mapping[str, Column]], keys: tuple[str, str]
) -> DataFrame:
    """Aggregate once and give ``(key0, key1, value DOUBLE)`` rows.

    ``entries`` is ``{name: {metric: aggregate}}``; wide tables are split into
    several aggregations so that generated code stays small.
    """
    flat = [(n, m, a) for n, metrics in entries.items() for m, a in metrics.items()]
    if not flat:
        schema = f"{keys[0]} string, {keys[1]} string, value double"
        return df.sparkSession.createDataFrame([], schema)
    parts = []
    for start in range(0, len(flat), _PER_JOB):
        batch = flat[start : start + _PER_JOB]
        one = df.agg(*[a.cast("double").alias(f"a{i}") for i, (_, _, a) in enumerate(batch)])
        cells = [
            F.struct(
                F.lit(n).alias(keys[0]), F.lit(m).alias(keys[1]), F.col(f"a{i}").alias("value")
            )
            for i, (n, m, _) in enumerate(batch)
        ]
        parts.append(one.select(F.inline(F.array(*cells))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_report(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``(column, missing, ratio, high_missing)`` per column, plus a total row.

    ``high_missing`` needs a ratio above the threshold. The total row has the name
    ``__total__`` and no ratio.
    """
    names = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(is_missing(df, n)).alias(f"n{i}") for i, n in enumerate(names)],
    )
    ratio = lambda i: F.try_divide(F.col(f"n{i}").cast("double"), F.col("rows"))
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"n{i}").alias("missing"),
            ratio(i).alias("ratio"),
            F.coalesce(ratio(i) > threshold, F.lit(False)).alias("high_missing"),
        )
        for i, n in enumerate(names)
    ]
    total = F.lit(0).cast("bigint")
    for i in range(len(names)):
        total = total + F.col(f"n{i}")
    cells.append(
        F.struct(
            F.lit("__total__").alias("column"),
            total.alias("missing"),
            F.lit(None).cast("double").alias("ratio"),
            F.lit(False).alias("high_missing"),
        )
    )
    return one.select(F.inline(F.array(*cells)))


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row ``(row_count, duplicate_count, duplicate_ratio)``.

    A duplicate repeats an earlier row in all columns, or in ``subset``.
    """
    names = list(subset) if subset else df.columns
    groups = df.groupBy(*[col(n) for n in names]).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("__n") - 1), F.lit(0))
    return groups.agg(
        total.alias("row_count"),
        extra.alias("duplicate_count"),
        F.coalesce(F.try_divide(extra.cast("double"), total), F.lit(0.0)).alias("duplicate_ratio"),
    )


def dtype_report(df: DataFrame) -> DataFrame:
    """``(data_type, n_columns, columns)`` from the schema; reads no data."""
    kinds: dict[str, list[str]] = {}
    for name, kind in df.dtypes:
        kinds.setdefault(kind, []).append(name)
    rows = [(k, len(v), ", ".join(v)) for k, v in kinds.items()]
    return df.sparkSession.createDataFrame(rows, "data_type string, n_columns int, columns string")


def numeric_report(
    df: DataFrame, expected: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """``(column, metric, value)``: fences, outliers, moments and violations."""
    names = numeric_columns(df)
    quartiles = exact_quantiles(df, {n: [0.25, 0.5, 0.75] for n in names})
    rows = F.count(F.lit(1))
    entries = {}
    for n in names:
        value = finite(col(n))
        lower, upper = fences(quartiles[n][0.25], quartiles[n][0.75])
        lo, hi = F.lit(lower).cast("double"), F.lit(upper).cast("double")
        hits = F.count_if((value < lo) | (value > hi))
        entries[n] = {
            "lower_bound": F.max(lo),
            "upper_bound": F.max(hi),
            "outlier_count": hits,
            "outlier_ratio": F.try_divide(hits.cast("double"), rows),
            "min": F.min(value),
            "max": F.max(value),
            "mean": F.avg(value),
            "median": F.max(F.lit(quartiles[n][0.5]).cast("double")),
            "std": F.stddev_samp(value),
        }
        if expected and n in expected:
            low, high = expected[n]
            entries[n]["range_violations"] = F.count_if((value < low) | (value > high))
    return agg_to_rows(df, entries, ("column", "metric"))


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` over several columns in one grouped pass."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    cells = [
        F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in columns
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(frequencies: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values per column, ties by value."""
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return (
        frequencies.filter("value is not null")
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )


def category_summary(
    frequencies: DataFrame, min_categories: int = 2, max_categories: int = 100
) -> DataFrame:
    """``(column, n_unique, null_count, warning)`` from ``value_frequencies``."""
    counts = frequencies.groupBy("column").agg(
        F.count("value").alias("n_unique"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
    )
    return counts.withColumn(
        "warning",
        F.when(F.col("n_unique") < min_categories, F.lit("few values")).when(
            F.col("n_unique") > max_categories, F.lit("high cardinality")
        ),
    )


def categorical_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    min_categories: int = 2,
    max_categories: int = 100,
) -> DataFrame:
    """``(column, n_unique, null_count, warning)`` per text column."""
    names = list(columns) if columns is not None else string_columns(df)
    return category_summary(value_frequencies(df, names), min_categories, max_categories)


def categorical_top(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """``(column, value, n, rank)``: the most frequent values per text column."""
    names = list(columns) if columns is not None else string_columns(df)
    return top_values(value_frequencies(df, names), k).select("column", "value", "n", "rank")


def _as_date(df: DataFrame, name: str, formats: Sequence[str] | None) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "date" or kind.startswith("timestamp"):
        return col(name).cast("date")
    if formats is None:
        return F.try_to_timestamp(col(name).cast("string")).cast("date")
    return parse_date(col(name), formats)


def date_report(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] | None = ("MMddyyyy",)
) -> DataFrame:
    """``(column, null_count, min_date, max_date, range_days)`` per present column.

    Text that is no date counts as null; with no date at all the range is 0 days.
    """
    names = [n for n in columns if n in df.columns]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, null_count bigint, min_date date, max_date date, range_days int"
        )
    aggregates = []
    for i, n in enumerate(names):
        day = _as_date(df, n, formats)
        aggregates += [
            F.count_if(day.isNull()).alias(f"n{i}"),
            F.min(day).alias(f"lo{i}"),
            F.max(day).alias(f"hi{i}"),
        ]
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"n{i}").alias("null_count"),
            F.col(f"lo{i}").alias("min_date"),
            F.col(f"hi{i}").alias("max_date"),
            F.coalesce(F.datediff(F.col(f"hi{i}"), F.col(f"lo{i}")), F.lit(0)).alias("range_days"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))
