"""Column selection and guards that only look at the schema (no job)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """Columns treated as categorical: text and boolean."""
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def float_columns(df: DataFrame) -> list[str]:
    kinds = (T.DoubleType, T.FloatType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def q(name: str) -> str:
    """Column name quoted for use in an expression."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(q(name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing: turn it into NULL in every float column."""
    names = float_columns(df)
    if not names:
        return df
    return df.withColumns({n: F.when(F.isnan(col(n)), F.lit(None)).otherwise(col(n)) for n in names})


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns of ``after`` that ``before`` does not have, in order."""
    known = set(before.columns)
    return [c for c in after.columns if c not in known]


def need(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def is_missing(df: DataFrame, name: str):
    """NULL, or NaN for a float column."""
    c = col(name)
    if name in float_columns(df):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Feed check, one row per required column.

    ``valid`` is false if a column is missing or the frame is empty; null counts
    inform only. ``valid`` is the verdict on the whole feed, so it is equal on
    all rows.
    """
    spark = df.sparkSession
    present = [c for c in required if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(present)],
    )
    entries = []
    for name in required:
        here = name in present
        nulls = F.col(f"n{present.index(name)}") if here else F.lit(None).cast("bigint")
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(here).alias("present"),
                nulls.alias("null_count"),
            )
        )
    ok = F.lit(len(present) == len(required)) & (F.col("row_count") > 0)
    if not entries:
        return spark.createDataFrame(
            [], "column string, present boolean, null_count bigint, row_count bigint, valid boolean"
        )
    return counts.select(
        F.explode(F.array(*entries)).alias("e"), "row_count", ok.alias("valid")
    ).select("e.*", "row_count", "valid")


def is_valid(df: DataFrame, required: Sequence[str]) -> bool:
    """The verdict alone; looks at no more than one row."""
    return all(c in df.columns for c in required) and not df.isEmpty()
