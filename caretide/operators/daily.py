"""Per-day aggregates of the feeds and their joins onto visits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.operators.feeds import union_feeds
from caretide.operators.ranks import running_totals
from caretide.operators.schema import col, need, numeric_columns, q
from caretide.session import broadcast_if_small, materialize, measured_side

# Lags in days and name parts of feed columns.
NEWS_LAGS = (1, 3, 5, 7)
FEED_MARKERS = ("news", "reddit", "twitter", "sentiment")
LIST_BYTES = 64 << 20
#: Bytes of a day's text from which visits of different days are kept apart; of all texts that
#: one task gives out; rows without text in one task.
_WIDE = 64 << 10
_TASK_BYTES = 16 << 30
_TASK_ROWS = 500_000


def _day(column: str = "date") -> Column:
    return F.to_date(col(column)).alias("day")


def _with_day(feed: DataFrame) -> DataFrame:
    return feed.withColumn("day", _day()).filter("day is not null")


def _check_list(feed: DataFrame, column: str, max_bytes: int) -> None:
    """Refuse a joined list that no single value could hold.

    ``daily_list_rows`` gives the same list at any size, one row per entry.
    """
    sizes = _with_day(feed).groupBy("day").agg(F.sum(F.octet_length(col(column)) + 2).alias("b"))
    largest = sizes.agg(F.max("b")).first()[0] or 0
    if largest > max_bytes:
        raise ValueError(
            f"a day's list of {column} takes {largest} bytes, above {max_bytes}: "
            "use with_lists=False and daily_list_rows"
        )


def _joined(column: str, order_by: Sequence[str]) -> Column:
    order = ", ".join(q(c) for c in order_by)
    return F.expr(f"listagg({q(column)}, ', ') within group (order by {order})").alias(column)


def daily_news(
    feed: DataFrame,
    order_by: Sequence[str] = ("date", "url"),
    with_lists: bool = True,
    max_list_bytes: int = LIST_BYTES,
) -> DataFrame:
    """``(day, news_mentions[, keywords])``: titles per day, keywords in row order."""
    aggregates = [F.count("title").alias("news_mentions")]
    if with_lists:
        need(feed, ["keywords", *order_by])
        _check_list(feed, "keywords", max_list_bytes)
        aggregates.append(_joined("keywords", order_by))
    return _with_day(feed).groupBy("day").agg(*aggregates)


def daily_forum(
    feed: DataFrame,
    order_by: Sequence[str] = ("date", "post_id"),
    with_lists: bool = True,
    max_list_bytes: int = LIST_BYTES,
) -> DataFrame:
    """``(day, reddit_posts, reddit_sentiment[, symptoms_mentioned])``."""
    aggregates = [
        F.count("post_id").alias("reddit_posts"),
        F.avg("sentiment_polarity").alias("reddit_sentiment"),
    ]
    if with_lists:
        need(feed, ["symptoms_mentioned", *order_by])
        _check_list(feed, "symptoms_mentioned", max_list_bytes)
        aggregates.append(_joined("symptoms_mentioned", order_by))
    return _with_day(feed).groupBy("day").agg(*aggregates)


def daily_short(feed: DataFrame) -> DataFrame:
    """``(day, tweet_count, twitter_sentiment, likes, retweets)``."""
    return (
        _with_day(feed)
        .groupBy("day")
        .agg(
            F.count("tweet_id").alias("tweet_count"),
            F.avg("sentiment_polarity").alias("twitter_sentiment"),
            F.sum("likes").cast("bigint").alias("likes"),
            F.sum("retweets").cast("bigint").alias("retweets"),
        )
    )


def daily_size(df: DataFrame, column: str = "date") -> DataFrame:
    """``(day, n)``: rows per day."""
    return df.filter(col(column).isNotNull()).groupBy(_day(column)).agg(F.count(F.lit(1)).alias("n"))


def daily_list_rows(feed: DataFrame, column: str, order_by: Sequence[str]) -> DataFrame:
    """A day's list in long form ``(day, position, item)``, for lists of any length."""
    rows = _with_day(feed).select("day", *[col(c) for c in order_by], col(column).alias("item"))
    rows = rows.filter("item is not null").withColumn("one", F.lit(1))
    placed = running_totals(rows, [F.col("day"), *[col(c) for c in order_by]], ["one"])
    starts = placed.groupBy("day").agg(F.min("one_before").alias("start"))
    return placed.join(measured_side(starts), "day").select(
        "day", (F.col("one_before") - F.col("start")).alias("position"), "item"
    )


def daily_lags(
    daily: DataFrame,
    column: str = "news_mentions",
    lags: Sequence[int] = NEWS_LAGS,
    calendar: bool = False,
) -> DataFrame:
    """``{column}_lag{n}`` on a daily table.

    By default ``n`` counts rows, so a gap makes lag 1 the previous day that has
    data; ``calendar=True`` looks up the date ``n`` days earlier. The window runs
    over one row per day, a table bounded by the calendar.
    """
    if calendar:
        out = daily
        for n in lags:
            past = daily.select(F.date_add("day", n).alias("day"), F.col(column).alias(f"{column}_lag{n}"))
            out = out.join(past, "day", "left")
        return out
    w = Window.orderBy("day")
    return daily.withColumns({f"{column}_lag{n}": F.lag(column, n).over(w) for n in lags})


def daily_rolling_mean(
    daily: DataFrame,
    column: str = "reddit_sentiment",
    window: int = 7,
    into: str | None = None,
) -> DataFrame:
    """Mean over the last ``window`` rows; null until all of them have a value."""
    frame = Window.orderBy("day").rowsBetween(1 - window, 0)
    mean = F.when(F.count(column).over(frame) == window, F.avg(column).over(frame))
    return daily.withColumn(into or f"{column}_{window}d", mean)


def has_rows(feed: DataFrame | None) -> bool:
    """Whether a feed is given and not empty; looks at no more than one row."""
    return feed is not None and not feed.isEmpty()


def _one_day_each(visits: DataFrame, sides: Sequence[DataFrame], visit_day: str) -> DataFrame:
    """``visits`` dealt out so that no task holds two days, if a day's texts are long.

    A writer that meets long texts of many days in turn holds a hundred rows' worth of them; of
    one day, it can keep the text once. Visits move before they get their texts, and a day with
    many visits is cut into pieces.
    """
    texts = [(s, [f.name for f in s.schema.fields if f.dataType.simpleString() == "string"]) for s in sides]
    sized = [
        s.select("day", sum(F.coalesce(F.octet_length(col(c)), F.lit(0)).cast("bigint") for c in names).alias("b"))
        for s, names in texts
        if names
    ]
    if not sized or visits.isStreaming:
        return visits
    wide = union_feeds(sized).groupBy("day").agg(F.sum("b").alias("b"))
    if (wide.agg(F.max("b")).first()[0] or 0) < _WIDE:
        return visits
    day = F.to_date(col(visit_day))
    rows = visits.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = materialize(rows.join(F.broadcast(wide), "day", "left"), "days")
    text, bare = days.agg(F.sum(F.col("n") * F.col("b")), F.sum(F.when(F.col("b").isNull(), F.col("n")))).first()
    cores = visits.sparkSession.sparkContext.defaultParallelism
    share = min(_TASK_BYTES, max(1, (text or 0) // (4 * cores)))
    rest = max(1, math.ceil((bare or 0) / _TASK_ROWS))
    pieces = F.greatest(F.lit(1), F.least("n", F.ceil(F.col("n") * F.col("b") / F.lit(share)))).cast("int")
    cut = days.filter("b is not null").select(F.col("day").alias("__day"), pieces.alias("__pieces"))
    # The window runs over one row per day.
    before = F.sum("__pieces").over(Window.orderBy("__day")) - F.col("__pieces")
    places = cut.withColumn("__first", before + F.lit(rest))
    count = rest + (cut.agg(F.sum("__pieces")).first()[0] or 0)
    hashed = [col(f.name) for f in visits.schema.fields if "map<" not in f.dataType.simpleString()]
    at = F.coalesce("__first", F.lit(0)) + F.pmod(F.xxhash64(*hashed), F.coalesce("__pieces", F.lit(rest)))
    placed = visits.join(F.broadcast(places), day == F.col("__day"), "left")
    dealt = placed.withColumn("__part", at.cast("int")).repartitionById(count, F.col("__part"))
    return dealt.select(*[col(c) for c in visits.columns])


def join_dailies(visits: DataFrame, dailies: Sequence[DataFrame], visit_day: str = "visit_date") -> DataFrame:
    """Left join of daily tables on the visit's day, one after the other.

    The daily sides are stored and measured first and only broadcast if small. If a day's text
    is long, the visits are dealt out by day before any of them gets it.
    """
    need(visits, [visit_day])
    names = list(visits.columns)
    for daily in dailies:
        new = [c for c in daily.columns if c != "day"]
        if clash := [c for c in new if c in names]:
            raise ValueError(f"columns exist on both sides: {clash}")
        names += new
    stored = [materialize(daily, "daily") for daily in dailies]
    sides = [broadcast_if_small(side) for side in stored]
    if all(hinted is not side for hinted, side in zip(sides, stored, strict=True)):
        visits = _one_day_each(visits, stored, visit_day)
    for side in sides:
        side = side.withColumnRenamed("day", "__day")
        visits = visits.join(side, F.to_date(col(visit_day)) == F.col("__day"), "left").drop("__day")
    return visits


def join_daily(
    visits: DataFrame,
    daily: DataFrame,
    visit_day: str = "visit_date",
    per_day: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left join of a daily table on the visit's day (see :func:`join_dailies`).

    ``per_day`` adds columns made of the daily ones. They are worked out and stored with each
    day; the same expression after the join would read a day's list again for every visit.
    """
    return join_dailies(visits, [daily.withColumns(dict(per_day or {}))], visit_day)


def join_news_daily(
    visits: DataFrame,
    news: DataFrame,
    visit_day: str = "visit_date",
    lags: Sequence[int] = NEWS_LAGS,
    calendar: bool = False,
    per_day: Mapping[str, Column] | None = None,
    **lists,
) -> DataFrame:
    daily = daily_lags(daily_news(news, **lists), lags=lags, calendar=calendar)
    return join_daily(visits, daily, visit_day, per_day)


def join_forum_daily(
    visits: DataFrame,
    forum: DataFrame,
    visit_day: str = "visit_date",
    per_day: Mapping[str, Column] | None = None,
    **lists,
) -> DataFrame:
    return join_daily(visits, daily_rolling_mean(daily_forum(forum, **lists)), visit_day, per_day)


def join_short_daily(visits: DataFrame, short: DataFrame, visit_day: str = "visit_date") -> DataFrame:
    return join_daily(visits, daily_short(short), visit_day)


def fill_feed_columns(df: DataFrame, markers: Sequence[str] = FEED_MARKERS) -> DataFrame:
    """Nulls become 0 in numeric columns whose name contains a marker."""
    names = [n for n in numeric_columns(df) if any(m in n for m in markers)]
    return df.na.fill(0, subset=names) if names else df


def merge_counts(
    visits: DataFrame,
    news: DataFrame | None = None,
    forum: DataFrame | None = None,
    short: DataFrame | None = None,
    visit_day: str = "visit_date",
) -> DataFrame:
    """Visits with ``cdc_count``, ``reddit_sentiment`` and ``twitter_count`` by day.

    A feed that is absent or empty adds no column. Then every numeric null becomes
    0, the visit's own columns included.
    """
    out = visits
    if has_rows(news):
        out = join_daily(out, daily_size(news).withColumnRenamed("n", "cdc_count"), visit_day)
    if has_rows(forum):
        mean = _with_day(forum).groupBy("day").agg(F.avg("sentiment_polarity").alias("reddit_sentiment"))
        out = join_daily(out, mean, visit_day)
    if has_rows(short):
        out = join_daily(out, daily_size(short).withColumnRenamed("n", "twitter_count"), visit_day)
    return out.na.fill(0)
