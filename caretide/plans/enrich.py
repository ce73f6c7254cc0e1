"""Visits with everything the feeds say about their day, and their features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from caretide.functions import dates
from caretide.operators import daily as dy
from caretide.operators import features as ft
from caretide.operators.sequence import lag_and_rolling


def enrich_visits(
    visits: DataFrame,
    news: DataFrame | None = None,
    forum: DataFrame | None = None,
    short: DataFrame | None = None,
    visit_day: str = "visit_date",
    with_lists: bool = False,
    calendar_lags: bool = False,
    news_order: Sequence[str] = ("date", "url"),
    forum_order: Sequence[str] = ("date", "post_id"),
) -> DataFrame:
    """Left join of the daily feed aggregates; days without feed values become 0.

    A feed that is absent or empty adds no column.

    The per-day keyword and symptom lists stay beside the visits, as rows
    (``daily.daily_list_rows``), since they grow with visits times posts;
    ``with_lists=True`` puts them on every visit of the day all the same.
    """
    dailies = []
    if dy.has_rows(news):
        mentions = dy.daily_news(news, order_by=news_order, with_lists=with_lists)
        dailies.append(dy.daily_lags(mentions, calendar=calendar_lags))
    if dy.has_rows(forum):
        posts = dy.daily_forum(forum, order_by=forum_order, with_lists=with_lists)
        dailies.append(dy.daily_rolling_mean(posts))
    if dy.has_rows(short):
        dailies.append(dy.daily_short(short))
    return dy.fill_feed_columns(dy.join_dailies(visits, dailies, visit_day))


def all_features(
    df: DataFrame,
    date_col: str = "visit_date",
    value_cols: Sequence[str] = (),
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    holidays: Sequence[str] = dates.HOLIDAYS,
    **how,
) -> DataFrame:
    """Calendar, cyclical, lag, rolling and interaction features.

    Lags and rolling values need ``order_by``; they are built if ``value_cols``
    are given. Existing ``month``, ``day_of_week`` and ``is_weekend`` are replaced.
    """
    out = ft.cyclical_features(ft.temporal_features(df, date_col, holidays))
    if value_cols:
        out = lag_and_rolling(out, value_cols, order_by, partition_by, **how)
    return ft.interaction_features(out)
