"""The full data-quality report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.operators import quality as ql
from caretide.operators.feeds import union_feeds
from caretide.operators.schema import string_columns
from caretide.session import materialize


def _tall(part: DataFrame, cells: Sequence[tuple[str, str, str]], column: str | None) -> DataFrame:
    """Rows of ``part`` as ``(check, column, metric, value)``; cells are (check, metric, source)."""
    name = F.col(column) if column else F.lit("__table__")
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            name.alias("column"),
            F.lit(metric).alias("metric"),
            F.col(source).cast("string").alias("value"),
        )
        for check, metric, source in cells
    ]
    return part.select(F.inline(F.array(*entries)))


def quality_report(
    df: DataFrame,
    expected: Mapping[str, tuple[float, float]] | None = None,
    date_columns: Sequence[str] = (),
    date_formats: Sequence[str] | None = ("MMddyyyy",),
    store: bool = False,
) -> DataFrame:
    """All checks in long form ``(check, column, metric, value STRING)``.

    The checks read ``df`` a few times; ``store`` writes it once first, for a table
    that is costly to compute.
    """
    if store:
        df = materialize(df, "report")

    def same(check: str, *metrics: str) -> list[tuple[str, str, str]]:
        return [(check, m, m) for m in metrics]

    rows = ql.duplicate_report(df).withColumn("n_columns", F.lit(len(df.columns)))
    table = [("dataset", "n_rows", "row_count"), ("dataset", "n_columns", "n_columns")]
    table += same("duplicates", "duplicate_count", "duplicate_ratio")
    frequencies = materialize(ql.value_frequencies(df, string_columns(df)), "values")
    top = ql.top_values(frequencies).withColumn(
        "metric", F.concat(F.col("rank").cast("string"), F.lit(": "), F.col("value"))
    )
    parts = [
        _tall(rows, table, None),
        _tall(ql.missing_report(df), same("missing", "missing", "ratio", "high_missing"), "column"),
        _tall(ql.dtype_report(df), same("types", "n_columns", "columns"), "data_type"),
        _tall(
            ql.category_summary(frequencies),
            same("categorical", "n_unique", "null_count", "warning"),
            "column",
        ),
        ql.numeric_report(df, expected).select(
            F.lit("numeric").alias("check"), "column", "metric", F.col("value").cast("string").alias("value")
        ),
        top.select(
            F.lit("top_values").alias("check"), "column", "metric", F.col("n").cast("string").alias("value")
        ),
    ]
    if date_columns:
        dates = ql.date_report(df, date_columns, date_formats)
        metrics = same("dates", "null_count", "min_date", "max_date", "range_days")
        parts.append(_tall(dates, metrics, "column"))
    return union_feeds(parts)
