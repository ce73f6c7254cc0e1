"""Feature columns on visit and daily tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.functions import dates
from caretide.functions.columns import finite, flag
from caretide.functions.measures import FLU_MONTHS
from caretide.operators.schema import col
from caretide.session import measured_side


def temporal_features(
    df: DataFrame,
    date_col: str = "visit_date",
    holidays: Sequence[str] = dates.HOLIDAYS,
    epoch: str = dates.EPOCH,
) -> DataFrame:
    """Calendar columns; the frame is unchanged if the date column is absent."""
    if date_col not in df.columns:
        return df
    return df.withColumns(dates.temporal_features(col(date_col), holidays, epoch))


def cyclical_features(df: DataFrame) -> DataFrame:
    """Sine and cosine of weekday, month and arrival hour, each if present."""
    added = {}
    for name, prefix, period in (
        ("day_of_week", "day_of_week", 7),
        ("month", "month", 12),
        ("arrival_hour", "hour", 24),
    ):
        if name in df.columns:
            added[f"{prefix}_sin"], added[f"{prefix}_cos"] = dates.cycle(col(name), period)
    return df.withColumns(added) if added else df


def interaction_features(df: DataFrame) -> DataFrame:
    """Products and joint flags of columns that are present."""
    have = set(df.columns)
    added = {}
    if {"is_weekend", "arrival_hour"} <= have:
        added["weekend_evening"] = flag(
            (F.col("is_weekend") == 1) & F.col("arrival_hour").between(18, 23)
        )
    if {"age_group", "has_insurance"} <= have:
        added["senior_uninsured"] = flag((F.col("age_group") == "65+") & (F.col("has_insurance") == 0))
    if {"is_weekend", "high_acuity"} <= have:
        added["weekend_high_acuity"] = F.col("is_weekend") * F.col("high_acuity")
    if "month" in have:
        added["is_flu_season"] = flag(F.col("month").isin(*FLU_MONTHS))
    return df.withColumns(added) if added else df


def group_stats_join(df: DataFrame, group_cols: Sequence[str], agg_col: str) -> DataFrame:
    """``{g}_mean, _std, _count, _min, _max`` of ``agg_col``, joined back per group.

    Groups are aggregated and joined rather than windowed: a window would put
    every group into one task. Rows with a null group get null statistics.
    """
    if agg_col not in df.columns:
        return df
    out = df
    value = finite(col(agg_col))
    for g in [c for c in group_cols if c in df.columns]:
        stats = (
            df.filter(col(g).isNotNull())
            .groupBy(col(g).alias("__g"))
            .agg(
                F.avg(value).alias(f"{g}_mean"),
                F.stddev_samp(value).alias(f"{g}_std"),
                F.count(value).alias(f"{g}_count"),
                F.min(value).alias(f"{g}_min"),
                F.max(value).alias(f"{g}_max"),
            )
        )
        clash = [c for c in stats.columns if c in out.columns]
        if clash:
            raise ValueError(f"columns already exist: {clash}")
        out = out.join(measured_side(stats, "groups"), out[g] == F.col("__g"), "left").drop("__g")
    return out
