"""Row filters, imputation, duplicate removal and outlier clipping."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.functions.dates import parse_date
from caretide.functions.text import strip
from caretide.operators.quantiles import exact_quantiles
from caretide.operators.schema import col, float_columns, need, numeric_columns, string_columns


def drop_blank_text(df: DataFrame, columns: Sequence[str] = ("text", "content")) -> DataFrame:
    """Keep rows whose text columns (those present) hold more than whitespace."""
    for name in columns:
        if name in df.columns:
            df = df.filter(F.length(strip(col(name))) > 0)
    return df


def parse_date_drop_bad(
    df: DataFrame,
    column: str,
    into: str | None = None,
    formats: Sequence[str] | None = ("MMddyyyy",),
) -> DataFrame:
    """Parse a date column and drop the rows that do not parse.

    ``formats=None`` reads ISO text or an existing date/timestamp.
    """
    parsed = F.try_to_timestamp(col(column)) if formats is None else parse_date(col(column), formats)
    if dict(df.dtypes)[column] in ("date", "timestamp"):
        parsed = col(column)
    elif dict(df.dtypes)[column] == "timestamp_ntz":
        parsed = col(column).cast("timestamp")
    into = into or column
    return df.withColumn(into, parsed).filter(F.col(into).isNotNull())


def polarity_range(df: DataFrame, column: str = "sentiment_polarity") -> DataFrame:
    """Keep scores in [-1, 1]; a missing score fails."""
    return df.filter(finite(col(column)).between(-1, 1))


def lookback_filter(df: DataFrame, as_of: str, days: int = 30, column: str = "date") -> DataFrame:
    """Rows at most ``days`` days before the moment ``as_of``."""
    start = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    return df.filter(col(column) >= start)


def since_filter(df: DataFrame, as_of: str, days: int = 7, column: str = "date") -> DataFrame:
    """Rows from the day ``days`` days before ``as_of`` on."""
    first = F.date_sub(F.to_date(F.to_timestamp(F.lit(as_of))), days)
    return df.filter(col(column) >= first.cast("timestamp"))


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, ties to the smallest; null if all null.

    All columns are counted in one grouped pass with map-side combine, so neither
    a frequent value nor many distinct values end up in one task.
    """
    if not columns:
        return {}
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("name"), col(n).cast("string").alias("value"))
                for n in columns
            ]
        )
    ).alias("cell")
    best = (
        df.select(cells)
        .select("cell.*")
        .filter("value is not null")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("name")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    )
    found = {r["name"]: r["value"] for r in best.collect()}
    return {n: found.get(n) for n in columns}


_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _null_counts(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Nulls per column, NaN included, in one pass."""
    if not names:
        return {}
    floats = set(float_columns(df))
    null = {n: col(n).isNull() | F.isnan(col(n)) if n in floats else col(n).isNull() for n in names}
    found = df.agg(*[F.count_if(null[n]).alias(f"c{i}") for i, n in enumerate(names)]).first()
    return dict(zip(names, found, strict=True))


def _beyond_double(df: DataFrame, names: Sequence[str]) -> set[str]:
    """Integer columns with values that DOUBLE cannot hold exactly."""
    if not names:
        return set()
    bound = F.lit(1 << 53)
    big = [F.coalesce(F.max(~col(n).cast("bigint").between(-bound, bound)), F.lit(False)).alias(f"c{i}") for i, n in enumerate(names)]
    return {n for n, hit in zip(names, df.agg(*big).first(), strict=True) if hit}


def impute(df: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Numeric nulls become the median, categorical nulls the mode.

    Only columns that hold nulls are looked at further and changed; one pass finds
    them. An integer column with nulls keeps its type unless its median is x.5, then
    it becomes DOUBLE, or, with values that DOUBLE cannot hold, keeps its type and
    takes the integer below. An all-null numeric column stays null; an all-null text
    column becomes ``unknown``.
    """
    every = [*numeric_columns(df), *string_columns(df)]
    gaps = _null_counts(df, every)
    numbers, texts = ([n for n in names if gaps[n]] for names in (numeric_columns(df), string_columns(df)))
    medians = exact_quantiles(df, {n: [0.5] for n in numbers}) if numbers else {}
    common = modes(df, texts)
    kinds = dict(df.dtypes)
    wide = _beyond_double(df, [n for n in numbers if kinds[n] in _INTEGERS])
    changed = {}
    for n in numbers:
        middle = medians[n][0.5]
        if middle is None:
            continue
        if kinds[n] in ("double", "float"):
            changed[n] = F.coalesce(finite(col(n)), F.lit(middle).cast("double")).cast(kinds[n])
        elif kinds[n] in _INTEGERS and middle != math.floor(middle) and n not in wide:
            changed[n] = F.coalesce(col(n).cast("double"), F.lit(middle))
        elif kinds[n] in _INTEGERS:
            changed[n] = F.coalesce(col(n), F.lit(math.floor(middle)).cast(kinds[n]))
        else:
            changed[n] = F.coalesce(col(n), F.lit(middle).cast(kinds[n]))
    for n in texts:
        if kinds[n] == "boolean" and common[n] is None:
            continue
        fill = unknown if common[n] is None else common[n]
        changed[n] = F.coalesce(col(n), F.lit(fill).cast(kinds[n]))
    return df.withColumns(changed) if changed else df


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of every row; nulls compare equal."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``order_by``.

    Spark cuts each key to one row inside every map task before the shuffle, so a
    key that fills the table still sends few rows to its task.
    """
    need(df, keys)
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_feed(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Unique on (date, title), or on (date, text) where there is no title."""
    keys = ["date", "title"] if "title" in df.columns else ["date", "text"]
    keys = [k for k in keys if k in df.columns]
    return keep_first(df, keys, order_by) if keys else df


def dedup_by_id(df: DataFrame, id_column: str, order_by: Sequence[Column | str]) -> DataFrame:
    return keep_first(df, [id_column], order_by)


def strip_diagnosis(df: DataFrame, marker: str = "DIAG") -> DataFrame:
    """Strip every column whose name contains ``marker``; null stays null."""
    names = [n for n in df.columns if marker in n]
    return df.withColumns({n: strip(col(n).cast("string")) for n in names}) if names else df


def winsorize_upper(
    df: DataFrame, p: float = 0.99, columns: Sequence[str] | None = None
) -> DataFrame:
    """Clip numeric columns above at their ``p`` quantile unless they are constant.

    By default every numeric column is clipped, flags included: a 0/1 flag that is
    set in less than ``1 - p`` of the rows becomes 0 everywhere. Nulls stay null. A
    column that nothing is clipped from stays as it is; an integer column keeps its
    type unless its cut is no integer, then it becomes DOUBLE, or, with values that
    DOUBLE cannot hold, is clipped at the integer below.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df
    bounds = exact_quantiles(df, {n: [0.0, p, 1.0] for n in names})
    kinds = dict(df.dtypes)
    clipped = [n for n in names if bounds[n][0.0] is not None and bounds[n][p] < bounds[n][1.0]]
    wide = _beyond_double(df, [n for n in clipped if kinds[n] in _INTEGERS])
    changed = {}
    for n in clipped:
        cut = bounds[n][p]
        if kinds[n] in _INTEGERS and (cut == math.floor(cut) or n in wide):
            limit, value = F.lit(math.floor(cut)).cast(kinds[n]), col(n)
        else:
            limit, value = F.lit(cut).cast("double"), finite(col(n))
        changed[n] = F.when(value > limit, limit).otherwise(value)
    return df.withColumns(changed) if changed else df


def fences(q1: float | None, q3: float | None) -> tuple[float | None, float | None]:
    """Lower and upper outlier bounds from the quartiles; Nones without data."""
    if q1 is None or q3 is None:
        return None, None
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def _column_fences(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    got = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    return fences(got[0.25], got[0.75])


def _outside(name: str, lower: float | None, upper: float | None) -> Column:
    value = finite(col(name))
    bounds = [F.lit(b).cast("double") for b in (lower, upper)]
    return F.coalesce((value < bounds[0]) | (value > bounds[1]), F.lit(False))


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """The rows outside the quartile fences of ``column``."""
    lower, upper = _column_fences(df, column)
    return df.filter(_outside(column, lower, upper))


def iqr_outlier_summary(df: DataFrame, column: str) -> DataFrame:
    """One row: outlier count, share of all rows in percent, and the fences."""
    lower, upper = _column_fences(df, column)
    hits, rows = F.count_if(_outside(column, lower, upper)), F.count(F.lit(1))
    return df.agg(
        hits.alias("n_outliers"),
        (F.try_divide(hits.cast("double"), rows) * 100).alias("pct_outliers"),
        F.lit(lower).cast("double").alias("lower_bound"),
        F.lit(upper).cast("double").alias("upper_bound"),
    )


def range_violations(df: DataFrame, expected: dict[str, tuple[float, float]]) -> DataFrame:
    """``(column, violations)``: values outside the expected closed range."""
    names = [n for n in expected if n in df.columns]
    counts = df.agg(
        *[F.count_if(_outside(n, *expected[n])).alias(f"v{i}") for i, n in enumerate(names)]
    )
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column"), F.col(f"v{i}").alias("violations"))
                    for i, n in enumerate(names)
                ]
            )
        ).alias("r")
    ).select("r.*")
