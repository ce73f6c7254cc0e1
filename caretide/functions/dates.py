"""Date and clock expressions (session time zone UTC is assumed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretide.functions.columns import as_col, flag
from caretide.functions.measures import bucketize

# The default holiday dates.
HOLIDAYS = ("2023-01-01", "2023-07-04", "2023-11-23", "2023-12-25")
EPOCH = "2020-01-01"
TIME_EDGES = (0, 6, 12, 18, 24)
TIME_LABELS = ("Night", "Morning", "Afternoon", "Evening")


def parse_date(c: Column | str, formats: Sequence[str] = ("MMddyyyy",)) -> Column:
    """First format that fits, as DATE; null if none does.

    A packed eight-digit format gets its leading zeros back first, because a
    numeric reader drops them.
    """
    text = as_col(c).cast("string")
    tries = []
    for fmt in formats:
        packed = fmt.isalpha() and len(fmt) == 8
        value = F.when(F.length(text) < 8, F.lpad(text, 8, "0")).otherwise(text) if packed else text
        tries.append(F.try_to_timestamp(value, F.lit(fmt)))
    return F.coalesce(*tries).cast("date")


def parse_iso_timestamp(c: Column | str, default: Column | str | None = None) -> Column:
    """ISO-8601 text (``Z`` allowed) to TIMESTAMP; ``default`` where it is missing."""
    parsed = F.try_to_timestamp(as_col(c))
    if default is None:
        return parsed
    fallback = F.to_timestamp(F.lit(default)) if isinstance(default, str) else default
    return F.coalesce(parsed, fallback)


def epoch_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_seconds(as_col(c))


def arrival_hour(c: Column | str) -> Column:
    """``HHMM`` clock to hour as DOUBLE; text that is no number gives null."""
    return F.floor(as_col(c).cast("string").try_cast("double") / 100).cast("double")


def time_of_day(hour: Column | str) -> Column:
    return bucketize(hour, TIME_EDGES, TIME_LABELS)


def weekday(c: Column | str) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(as_col(c))


def temporal_features(
    c: Column | str, holidays: Sequence[str] = HOLIDAYS, epoch: str = EPOCH
) -> dict[str, Column]:
    """Calendar columns by name. Flags of a null date are 0, other values null."""
    day = as_col(c).cast("date")
    dow = F.weekday(day)
    holiday = day.isin(*[F.lit(h).cast("date") for h in holidays]) if holidays else F.lit(False)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": dow,
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
        "is_weekend": flag(dow >= 5),
        "is_monday": flag(dow == 0),
        "is_friday": flag(dow == 4),
        "is_month_start": flag(F.dayofmonth(day) == 1),
        "is_month_end": flag(day == F.last_day(day)),
        "is_holiday": flag(holiday),
        "days_since_epoch": F.datediff(day, F.lit(epoch).cast("date")),
    }


def cycle(c: Column | str, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a periodic value."""
    angle = 2 * F.pi() * as_col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)
