"""Lag and rolling features over an explicit row order.

Without a key, or with a key that holds too many rows for one task, the table is
cut into consecutive ranges; each range gets copies of the few rows before it,
and the windows run inside the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.operators.ranks import PART, one_task_each, range_parts
from caretide.operators.schema import col, need

# Lags and window lengths in rows.
DEFAULT_LAGS = (1, 3, 7, 14)
DEFAULT_WINDOWS = (3, 7, 14)
_HALO = "__halo"


def _lag_columns(columns: Sequence[str], lags: Sequence[int]):
    def build(w: WindowSpec) -> dict[str, Column]:
        return {f"{c}_lag{n}": F.lag(col(c), n).over(w) for c in columns for n in lags}

    return build


def _rolling_columns(columns: Sequence[str], windows: Sequence[int]):
    def build(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in columns:
            value = finite(col(c))
            for n in windows:
                frame = w.rowsBetween(1 - n, 0)
                full = F.count(value).over(frame) == n
                for name, f in (
                    ("mean", F.avg),
                    ("std", F.stddev_samp),
                    ("max", F.max),
                    ("min", F.min),
                ):
                    out[f"{c}_rolling_{name}_{n}d"] = F.when(full, f(value).over(frame))
        return out

    return build


def with_row_window(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    reach: int,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    rows_per_task: int = 2_000_000,
    parts: int | None = None,
    daily: bool = False,
) -> DataFrame:
    """Add window columns that look back at most ``reach`` rows in ``order_by``.

    ``order_by`` (with ``partition_by``) must order rows uniquely: end it with an
    id. A keyed window is planned plainly while no key holds more than
    ``rows_per_task`` rows; otherwise the order is cut into ranges. ``daily``
    states that the table holds one row per day (and key), which the calendar
    bounds, so a plain window will do.
    """
    need(df, [*order_by, *partition_by])
    keys = [col(c) for c in partition_by]
    order = [col(c) for c in order_by]
    if daily:
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    if keys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        largest = sizes.agg(F.max("__n")).first()[0] or 0
        if largest <= rows_per_task:
            return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    return _in_ranges(df, build, reach, order, keys, parts)


def _in_ranges(df, build, reach, order, keys, parts) -> DataFrame:
    line = [*keys, *order]
    ranged = range_parts(df, line, parts)
    # One number per partition comes to the driver: how many rows it holds.
    sizes = sorted(tuple(r) for r in ranged.groupBy(PART).count().collect())
    halo_of = _halo_plan(sizes, reach)
    body = ranged.withColumn(_HALO, F.lit(False))
    if halo_of:
        plan = df.sparkSession.createDataFrame(halo_of, f"{PART} int, __to int, __need bigint")
        last = Window.partitionBy(PART).orderBy(*[c.desc() for c in line])
        tails = (
            ranged.withColumn("__rn", F.row_number().over(last))
            .filter(F.col("__rn") <= reach)
            .join(F.broadcast(plan), PART)
            .filter(F.col("__rn") <= F.col("__need"))
            .withColumn(PART, F.col("__to"))
            .withColumn(_HALO, F.lit(True))
        )
        body = body.unionByName(tails.select(*[col(c) for c in body.columns]))
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    count = sizes[-1][0] + 1 if sizes else 1
    return one_task_each(body, count).withColumns(build(w)).filter(~F.col(_HALO)).drop(PART, _HALO)


def _halo_plan(sizes: list[tuple[int, int]], reach: int) -> list[tuple[int, int, int]]:
    """(from part, to part, rows) so that every part sees ``reach`` earlier rows."""
    plan = []
    for at, (part, _) in enumerate(sizes):
        missing = reach
        for source, held in reversed(sizes[:at]):
            take = min(missing, held)
            plan.append((source, part, take))
            missing -= take
            if not missing:
                break
    return plan


def lagged_features(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    lags: Sequence[int] = DEFAULT_LAGS,
    **how,
) -> DataFrame:
    """``{c}_lag{n}``: the value ``n`` rows earlier. Absent columns are skipped."""
    here = [c for c in columns if c in df.columns]
    if not here or not lags:
        return df
    return with_row_window(
        df, _lag_columns(here, lags), max(lags), order_by, partition_by, **how
    )


def rolling_features(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    windows: Sequence[int] = DEFAULT_WINDOWS,
    **how,
) -> DataFrame:
    """``{c}_rolling_{mean,std,max,min}_{w}d`` over the last ``w`` rows.

    Null until all ``w`` values are present. ``d`` counts rows, not days.
    """
    here = [c for c in columns if c in df.columns]
    if not here or not windows:
        return df
    return with_row_window(
        df, _rolling_columns(here, windows), max(windows) - 1, order_by, partition_by, **how
    )


def lag_and_rolling(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    lags: Sequence[int] = DEFAULT_LAGS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    **how,
) -> DataFrame:
    """Both kinds on one ordering, so the table is shuffled once."""
    here = [c for c in columns if c in df.columns]
    if not here:
        return df
    lag, rolling = _lag_columns(here, lags), _rolling_columns(here, windows)
    reach = max([*lags, *[w - 1 for w in windows]])
    return with_row_window(
        df, lambda w: {**lag(w), **rolling(w)}, reach, order_by, partition_by, **how
    )
