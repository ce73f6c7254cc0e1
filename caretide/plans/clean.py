"""Cleaning pipelines. The order of the steps is part of the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretide.functions import dates
from caretide.functions import measures as ms
from caretide.functions.columns import flag
from caretide.functions.text import strip
from caretide.operators import cleaning as cl
from caretide.operators.schema import col
from caretide.session import materialize

TEXT_COLUMNS = ("text", "title", "content", "clean_text")


def derive_visits(df: DataFrame, date_formats: Sequence[str] = ("MMddyyyy",)) -> DataFrame:
    """Date, bands, flags and calendar of a visit table; each if its source is present."""
    have = set(df.columns)
    added: dict[str, Column] = {}
    if "VDATE" in have:
        added["visit_date"] = dates.parse_date(col("VDATE"), date_formats)
    if "AGE" in have:
        added["age_group"] = ms.age_group("AGE")
    if "ARRTIME" in have:
        hour = dates.arrival_hour("ARRTIME")
        added["arrival_hour"] = hour
        added["time_of_day"] = dates.time_of_day(hour)
    if "IMMEDR" in have:
        added["high_acuity"] = ms.acuity_flag("IMMEDR")
    if "PAYTYPER" in have:
        added["has_insurance"] = ms.insured_flag("PAYTYPER")
    out = cl.strip_diagnosis(df.withColumns(added) if added else df)
    if "visit_date" in out.columns:
        weekday = F.weekday("visit_date")
        out = out.withColumns(
            {"day_of_week": weekday, "is_weekend": flag(weekday >= 5), "month": F.month("visit_date")}
        )
    return out


def clean_visits(
    df: DataFrame,
    date_formats: Sequence[str] = ("MMddyyyy",),
    clip_at: float = 0.99,
    clip_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Impute, drop copies, derive columns, clip.

    Two statistics passes happen now (imputation values, clip bounds). The table
    between them is stored once, so the copies are not removed again for every
    later pass.
    """
    whole = materialize(derive_visits(cl.drop_exact_duplicates(cl.impute(df)), date_formats), "visits")
    return cl.winsorize_upper(whole, clip_at, clip_columns)


def clean_feed(
    df: DataFrame,
    order_by: Sequence[Column | str],
    date_formats: Sequence[str] | None = None,
    sort: bool = True,
) -> DataFrame:
    """Drop blanks and bad dates, normalise text, drop bad scores and repeats.

    ``order_by`` says which of several rows with the same date and title is first.
    """
    out = cl.drop_blank_text(df)
    if "date" in out.columns:
        out = cl.parse_date_drop_bad(out, "date", formats=date_formats)
    texts = [c for c in TEXT_COLUMNS if c in out.columns]
    if texts:
        out = out.withColumns(
            {**{f"{c}_lower": F.lower(col(c)) for c in texts}, **{c: strip(col(c)) for c in texts}}
        )
    if "sentiment_polarity" in out.columns:
        out = cl.polarity_range(out)
    out = cl.dedup_feed(out, order_by)
    if "date" in out.columns:
        out = out.withColumns(
            {"day_of_week": F.weekday("date"), "month": F.month("date"), "year": F.year("date")}
        )
        if sort:
            out = out.orderBy("date", *order_by)
    return out
