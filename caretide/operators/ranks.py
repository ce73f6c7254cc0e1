"""Running totals and ranks over a whole table, without a single-task window.

Rows are range-partitioned by the order keys and written once, so the cut
between partitions is fixed; each partition is then summed by itself and shifted
by the totals of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.operators.schema import col
from caretide.session import materialize

PART = "__part"


def range_parts(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """``df`` cut into consecutive ranges of ``order``; ``__part`` numbers them.

    The result is stored, because range bounds come from a sample and a
    recomputed plan could cut elsewhere.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), "ranges")


def one_task_each(ranged: DataFrame, count: int | None = None) -> DataFrame:
    """Rows of every range in a task of their own; hashing would pair some up."""
    if count is None:
        count = (ranged.agg(F.max(PART)).first()[0] or 0) + 1
    return ranged.repartitionById(count, F.col(PART)) if count > 1 else ranged


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Add ``{c}_before``: the sum of ``c`` over all rows earlier in ``order``.

    ``order`` must be unique per row. The number of rows of the helper window is
    the number of partitions, never the number of data rows.
    """
    ranged = range_parts(df, order, parts)
    totals = ranged.groupBy(PART).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    by_part = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PART,
        *[F.coalesce(F.sum(f"__t_{c}").over(by_part), F.lit(0)).alias(f"__o_{c}") for c in sums],
    )
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = one_task_each(ranged).select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__l_{c}") for c in sums]
    )
    joined = local.join(F.broadcast(offsets), PART)
    return joined.select(
        *[col(c) for c in df.columns], *[(F.col(f"__o_{c}") + F.col(f"__l_{c}")).alias(f"{c}_before") for c in sums]
    )


def value_ranks(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """``(value, n, n_before, mid_rank)`` per distinct value, ranks from 1.

    Equal values share the mean of their ranks. Copies are counted before
    anything moves, so a value that fills the table is still one row.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (
        df.select(finite(col(column)).alias("value"), *([weight] if weight else []))
        .filter("value is not null")
        .groupBy("value")
        .agg(n.cast("bigint").alias("n"))
    )
    ranked = running_totals(counts, [F.col("value")], ["n"])
    return ranked.withColumn("mid_rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))
