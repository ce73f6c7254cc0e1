"""Banding, flags, labels and number formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretide.functions.columns import as_col, flag

# Age bands and triage / payment codes.
AGE_EDGES = (0, 18, 45, 65, 120)
AGE_LABELS = ("0-17", "18-44", "45-64", "65+")
HIGH_ACUITY_CODES = (1, 2)
UNINSURED_CODES = (5, 6)
FLU_MONTHS = (10, 11, 12, 1, 2, 3)


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bands ``[lo, hi)``; outside every band gives null."""
    value = as_col(c)
    chain = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (value >= lo) & (value < hi)
        chain = F.when(inside, F.lit(label)) if chain is None else chain.when(inside, F.lit(label))
    return chain


def age_group(c: Column | str) -> Column:
    return bucketize(c, AGE_EDGES, AGE_LABELS)


def acuity_flag(c: Column | str, codes: Sequence[int] = HIGH_ACUITY_CODES) -> Column:
    return flag(as_col(c).isin(*codes))


def insured_flag(c: Column | str, uninsured: Sequence[int] = UNINSURED_CODES) -> Column:
    """1 unless the payment code marks no insurance; an unknown code counts as 1."""
    return 1 - flag(as_col(c).isin(*uninsured))


def sentiment_label(polarity: Column | str) -> Column:
    p = as_col(polarity)
    return (
        F.when(p > 0.3, F.lit("positive")).when(p < -0.3, F.lit("negative")).otherwise(F.lit("neutral"))
    )


def sentiment_category(polarity: Column | str) -> Column:
    """Right-closed bands of (-1, 1]; exactly -1 lies in none of them."""
    p = as_col(polarity)
    return (
        F.when((p > -1) & (p <= -0.3), F.lit("Negative"))
        .when((p > -0.3) & (p <= 0.3), F.lit("Neutral"))
        .when((p > 0.3) & (p <= 1), F.lit("Positive"))
    )


def pct_change(old: Column | str, new: Column | str) -> Column:
    """Percent change; 0 where the old value is 0."""
    a, b = as_col(old).cast("double"), as_col(new).cast("double")
    return F.when(a == 0, F.lit(0.0)).otherwise((b - a) / a * 100)


def human_number(c: Column | str) -> Column:
    """Whole numbers as ``1.2K`` / ``3.4M``, one decimal of the double quotient.

    The digits are worked out in whole numbers. Only a remainder of exactly half
    a tenth depends on the double itself: with ``m`` the odd number of half
    tenths, ``d = m / 20`` and ``(d*16 - m) + d*4`` is free of rounding, so its
    sign tells on which side of the half ``d`` lies (0: half to even).
    """
    n = as_col(c).cast("bigint")

    def scaled(unit: int, suffix: str) -> Column:
        tenth = unit // 10
        half = tenth // 2
        rest = n % tenth
        tenths = ((n - rest) / F.lit(tenth)).cast("bigint")
        m = (2 * tenths + 1).cast("double")
        d = n.cast("double") / F.lit(float(unit))
        side = (d * 16 - m) + d * 4
        up = (rest > half) | (
            (rest == half) & ((side > 0) | ((side == 0) & (tenths % 2 == 1)))
        )
        rounded = tenths + up.cast("bigint")
        whole = ((rounded - rounded % 10) / F.lit(10)).cast("bigint")
        return F.concat(whole.cast("string"), F.lit("."), (rounded % 10).cast("string"), F.lit(suffix))

    return (
        F.when(n >= 1_000_000, scaled(1_000_000, "M"))
        .when(n >= 1_000, scaled(1_000, "K"))
        .otherwise(n.cast("string"))
    )
