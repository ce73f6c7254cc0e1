"""Column expressions: text, dates, bands, flags and numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide.functions import dates as dt
from caretide.functions import measures as ms
from caretide.functions import text as tx
from caretide.operators import features as ft
from caretide.plans import enrich
from checks.registry import (
    DUCK_SPACE as SP,
    DUCK_WORD as WD,
    TERMS,
    duck_date,
    duck_keywords,
    duck_strip,
    query,
    r,
    rounded,
    table,
    text_date,
    text_time,
    view,
    with_views,
)

HOLIDAYS = ("2024-01-01", "2024-01-15", "1996-07-04", "1998-12-25")


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


@query("extract_keywords", f"SELECT doc_id, {duck_keywords('text')} AS keywords FROM documents")
def extract_keywords(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", tx.extract_keywords("text", TERMS).alias("keywords"))


@query(
    "extract_keywords_default",
    f"""SELECT page_id, {duck_keywords("concat(url, ' ', html)", tx.NEWS_KEYWORDS)} AS news,
        {duck_keywords('html', tx.SHORT_POST_KEYWORDS)} AS short_posts,
        {duck_keywords('html', tx.SYMPTOMS)} AS symptoms FROM pages""",
)
def extract_keywords_default(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        tx.extract_keywords(F.concat_ws(" ", "url", "html"), tx.NEWS_KEYWORDS).alias("news"),
        tx.extract_keywords("html", tx.SHORT_POST_KEYWORDS).alias("short_posts"),
        tx.extract_keywords("html", tx.SYMPTOMS).alias("symptoms"),
    )


_RULES = (("First", ("test", "license")), ("Second", ("und ", "que ")), ("Third", ("tion",)))


@query(
    "categorize",
    f"""SELECT doc_id, CASE WHEN {_any('text', _RULES[0][1])} THEN 'First'
        WHEN {_any('text', _RULES[1][1])} THEN 'Second'
        WHEN {_any('text', _RULES[2][1])} THEN 'Third' ELSE 'General Health' END AS by_rules,
        CASE WHEN {_any('text', ('outbreak', 'epidemic', 'surge'))} THEN 'Outbreak'
        WHEN {_any('text', ('vaccine', 'vaccination', 'immunization'))} THEN 'Vaccination'
        WHEN {_any('text', ('advisory', 'alert', 'warning'))} THEN 'Alert'
        WHEN {_any('text', ('flu', 'influenza', 'respiratory'))} THEN 'Respiratory Illness'
        ELSE 'General Health' END AS category FROM documents""",
)
def categorize(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.categorize("text", _RULES).alias("by_rules"),
        tx.categorize("text").alias("category"),
    )


@query(
    "lower_copy",
    with_views("v_posts") + " SELECT post_id, lower(text) AS text_lower FROM v_posts",
)
def lower_copy(spark, sf):
    return view(spark, sf, "v_posts").select("post_id", F.lower("text").alias("text_lower"))


@query(
    "strip_text",
    with_views("v_posts")
    + f" SELECT post_id, {duck_strip('text')} AS text, "
    + duck_strip("concat(chr(160), chr(9), title, chr(8195), chr(10))")
    + " AS padded FROM v_posts",
)
def strip_text(spark, sf):
    pad = F.concat(F.lit("\u00a0\t"), F.col("title"), F.lit("\u2003\n"))
    return view(spark, sf, "v_posts").select(
        "post_id", tx.strip("text").alias("text"), tx.strip(pad).alias("padded")
    )


_NO_URL = f"regexp_replace(text, '(?:http|www)[^{SP}]+', '', 'g')"
_POST = f"regexp_replace({_NO_URL}, '[^{WD}{SP}'']', ' ', 'g')"
_COLLAPSE = f"regexp_replace(%s, '[{SP}]+', ' ', 'g')"


@query(
    "clean_post_text",
    f"SELECT doc_id, {duck_strip(_COLLAPSE % _POST)} AS clean FROM documents",
)
def clean_post_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_post_text("text").alias("clean"))


def _short(c: str) -> str:
    out = f"regexp_replace({c}, '(?:http|www)[^{SP}]+', '', 'g')"
    out = f"regexp_replace({out}, '@[{WD}]+', '', 'g')"
    out = f"regexp_replace({out}, '#([{WD}]+)', '\\1', 'g')"
    out = f"regexp_replace({out}, '[^{WD}{SP}]', ' ', 'g')"
    return duck_strip(_COLLAPSE % out)


@query(
    "clean_tweet_text",
    f"SELECT 'd' AS origin, doc_id AS id, {_short('text')} AS clean FROM documents"
    f" UNION ALL SELECT 'p' AS origin, page_id AS id, {_short('html')} AS clean FROM pages",
)
def clean_tweet_text(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.lit("d").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("t")
    )
    pages = table(spark, sf, "pages").select(
        F.lit("p").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("t")
    )
    return docs.unionByName(pages).select("origin", "id", tx.clean_short_text("t").alias("clean"))


@query(
    "is_health_related",
    f"""SELECT doc_id, {_any('text', tx.HEALTH_WORDS)} AS is_health_related,
        {_any('text', ('test', 'que'))} AS with_terms FROM documents""",
)
def is_health_related(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.is_health_related("text").alias("is_health_related"),
        tx.is_health_related("text", ("test", "que")).alias("with_terms"),
    )


@query(
    "truncate",
    "SELECT doc_id, substring(text,1,5000) AS news, substring(text,1,1000) AS post,"
    " substring(text,1,280) AS short FROM documents",
)
def truncate(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.truncate("text", 5000).alias("news"),
        tx.truncate("text", 1000).alias("post"),
        tx.truncate("text", 280).alias("short"),
    )


@query(
    "absolute_url",
    """SELECT page_id, CASE WHEN starts_with(url,'http') THEN url ELSE 'https://base.example' || url END AS url,
       'https://base.example/p/' || CAST(page_id AS VARCHAR) AS relative FROM pages""",
)
def absolute_url(spark, sf):
    base = "https://base.example"
    path = F.concat(F.lit("/p/"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select(
        "page_id",
        tx.absolute_url("url", base).alias("url"),
        tx.absolute_url(path, base).alias("relative"),
    )


_VISIT_DATE = "CAST(try_strptime(VDATE, '%m%d%Y') AS DATE)"


@query(
    "parse_visit_date",
    with_views("v_visits") + f" SELECT visit_id, {duck_date(_VISIT_DATE)} AS visit_date FROM v_visits",
)
def parse_visit_date(spark, sf):
    return view(spark, sf, "v_visits").select(
        "visit_id", text_date(dt.parse_date("VDATE")).alias("visit_date")
    )


DUCK_AGE_GROUP = """CASE WHEN AGE >= 0 AND AGE < 18 THEN '0-17' WHEN AGE >= 18 AND AGE < 45 THEN '18-44'
    WHEN AGE >= 45 AND AGE < 65 THEN '45-64' WHEN AGE >= 65 AND AGE < 120 THEN '65+' END"""
DUCK_HOUR = "floor(TRY_CAST(ARRTIME AS DOUBLE) / 100)"


def duck_time_of_day(hour: str) -> str:
    return f"""CASE WHEN {hour} >= 0 AND {hour} < 6 THEN 'Night' WHEN {hour} >= 6 AND {hour} < 12
        THEN 'Morning' WHEN {hour} >= 12 AND {hour} < 18 THEN 'Afternoon'
        WHEN {hour} >= 18 AND {hour} < 24 THEN 'Evening' END"""


@query(
    "bucketize",
    with_views("v_visits") + f" SELECT visit_id, AGE, {DUCK_AGE_GROUP} AS age_group FROM v_visits",
)
def bucketize(spark, sf):
    return view(spark, sf, "v_visits").select("visit_id", "AGE", ms.age_group("AGE").alias("age_group"))


@query(
    "arrival_hour",
    with_views("v_visits")
    + f" SELECT visit_id, {DUCK_HOUR} AS arrival_hour, {duck_time_of_day(DUCK_HOUR)} AS time_of_day FROM v_visits",
)
def arrival_hour(spark, sf):
    hour = dt.arrival_hour("ARRTIME")
    return view(spark, sf, "v_visits").select(
        "visit_id", hour.alias("arrival_hour"), dt.time_of_day(hour).alias("time_of_day")
    )


@query(
    "acuity_flag",
    with_views("v_visits")
    + " SELECT visit_id, CAST(coalesce(IMMEDR IN (1,2), false) AS INT) AS high_acuity FROM v_visits",
)
def acuity_flag(spark, sf):
    return view(spark, sf, "v_visits").select("visit_id", ms.acuity_flag("IMMEDR").alias("high_acuity"))


@query(
    "insured_flag",
    with_views("v_visits")
    + " SELECT visit_id, CASE WHEN PAYTYPER IN (5,6) THEN 0 ELSE 1 END AS has_insurance FROM v_visits",
)
def insured_flag(spark, sf):
    return view(spark, sf, "v_visits").select(
        "visit_id", ms.insured_flag("PAYTYPER").alias("has_insurance")
    )


@query(
    "calendar",
    with_views("v_visits")
    + f""", d AS (SELECT visit_id, {_VISIT_DATE} AS visit_date FROM v_visits)
    SELECT visit_id, CAST(isodow(visit_date) - 1 AS INT) AS day_of_week,
      CAST(coalesce(isodow(visit_date) >= 6, false) AS INT) AS is_weekend,
      CAST(month(visit_date) AS INT) AS month, CAST(year(visit_date) AS INT) AS year FROM d""",
)
def calendar(spark, sf):
    day = view(spark, sf, "v_visits").select("visit_id", dt.parse_date("VDATE").alias("visit_date"))
    weekday = dt.weekday("visit_date")
    return day.select(
        "visit_id",
        weekday.alias("day_of_week"),
        dt.flag(weekday >= 5).alias("is_weekend"),
        F.month("visit_date").alias("month"),
        F.year("visit_date").alias("year"),
    )


def duck_temporal(day: str) -> str:
    dates = ", ".join(f"DATE '{h}'" for h in HOLIDAYS)
    return f"""CAST(year({day}) AS INT) AS year, CAST(month({day}) AS INT) AS month,
      CAST(day({day}) AS INT) AS day, CAST(isodow({day}) - 1 AS INT) AS day_of_week,
      CAST(week({day}) AS INT) AS week_of_year, CAST(quarter({day}) AS INT) AS quarter,
      CAST(coalesce(isodow({day}) >= 6, false) AS INT) AS is_weekend,
      CAST(coalesce(isodow({day}) = 1, false) AS INT) AS is_monday,
      CAST(coalesce(isodow({day}) = 5, false) AS INT) AS is_friday,
      CAST(coalesce(day({day}) = 1, false) AS INT) AS is_month_start,
      CAST(coalesce({day} = last_day({day}), false) AS INT) AS is_month_end,
      CAST(coalesce({day} IN ({dates}), false) AS INT) AS is_holiday,
      CAST(date_diff('day', DATE '2020-01-01', {day}) AS INT) AS days_since_epoch"""


@query(
    "temporal_features",
    with_views("v_visits")
    + f""", d AS (SELECT 'visit' AS origin, visit_id AS id, {_VISIT_DATE} AS dy FROM v_visits
      UNION ALL SELECT 'order', o_orderkey, CAST(o_orderdate AS DATE) FROM orders)
    SELECT origin, id, {duck_temporal('dy')} FROM d""",
)
def temporal_features(spark, sf):
    visits = view(spark, sf, "v_visits").select(
        F.lit("visit").alias("origin"), F.col("visit_id").alias("id"), dt.parse_date("VDATE").alias("dy")
    )
    orders = table(spark, sf, "orders").select(
        F.lit("order").alias("origin"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("dy")
    )
    return ft.temporal_features(visits.unionByName(orders), "dy", HOLIDAYS).drop("dy")


def duck_cycles() -> str:
    out = []
    for c, prefix, n in (
        ("day_of_week", "day_of_week", 7),
        ("month", "month", 12),
        ("arrival_hour", "hour", 24),
    ):
        for fn in ("sin", "cos"):
            out.append(f"round({fn}(2 * pi() * {c} / {n}), 6) AS {prefix}_{fn}")
    return ", ".join(out)


CYCLES = [f"{p}_{f}" for p in ("day_of_week", "month", "hour") for f in ("sin", "cos")]
DUCK_DERIVED = f"""d AS (SELECT *, {_VISIT_DATE} AS visit_date, {DUCK_HOUR} AS arrival_hour,
    {DUCK_AGE_GROUP} AS age_group, CAST(coalesce(IMMEDR IN (1,2), false) AS INT) AS high_acuity,
    CASE WHEN PAYTYPER IN (5,6) THEN 0 ELSE 1 END AS has_insurance FROM v_visits),
  e AS (SELECT *, CAST(isodow(visit_date) - 1 AS INT) AS day_of_week, CAST(month(visit_date) AS INT) AS month,
    CAST(coalesce(isodow(visit_date) >= 6, false) AS INT) AS is_weekend FROM d)"""
DUCK_INTERACTIONS = """CAST(coalesce(is_weekend = 1 AND arrival_hour BETWEEN 18 AND 23, false) AS INT) AS weekend_evening,
    CAST(coalesce(age_group = '65+' AND has_insurance = 0, false) AS INT) AS senior_uninsured,
    is_weekend * high_acuity AS weekend_high_acuity,
    CAST(coalesce(month IN (10,11,12,1,2,3), false) AS INT) AS is_flu_season"""


def derived(spark, sf):
    """Visits with derived columns, but neither imputed nor clipped."""
    from caretide.plans.clean import derive_visits

    return derive_visits(view(spark, sf, "v_visits"))


@query(
    "cyclical_features",
    with_views("v_visits") + f", {DUCK_DERIVED} SELECT visit_id, {duck_cycles()} FROM e",
)
def cyclical_features(spark, sf):
    return rounded(ft.cyclical_features(derived(spark, sf)), *CYCLES).select("visit_id", *CYCLES)


INTERACTIONS = ["weekend_evening", "senior_uninsured", "weekend_high_acuity", "is_flu_season"]


@query(
    "interaction_features",
    with_views("v_visits") + f", {DUCK_DERIVED} SELECT visit_id, {DUCK_INTERACTIONS} FROM e",
)
def interaction_features(spark, sf):
    return ft.interaction_features(derived(spark, sf)).select("visit_id", *INTERACTIONS)


def _duck_lags(c: str, order: str) -> str:
    return ", ".join(f"lag({c}, {n}) OVER ({order}) AS {c}_lag{n}" for n in (1, 3, 7, 14))


def _duck_rolling(c: str, order: str) -> str:
    out = []
    for n in (3, 7, 14):
        frame = f"OVER ({order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")):
            out.append(
                f"round(CASE WHEN count({c}) {frame} = {n} THEN {fn}({c}) {frame} END, 6)"
                f" AS {c}_rolling_{name}_{n}d"
            )
    return ", ".join(out)


ROLLING = [f"_rolling_{s}_{n}d" for n in (3, 7, 14) for s in ("mean", "std", "max", "min")]
_TEMPORAL_NAMES = (
    "year month day day_of_week week_of_year quarter is_weekend is_monday is_friday"
    " is_month_start is_month_end is_holiday days_since_epoch"
).split()


@query(
    "all_features",
    with_views("v_visits")
    + f""", {DUCK_DERIVED},
    f AS (SELECT visit_id, visit_ts, WAITTIME, arrival_hour, age_group, high_acuity, has_insurance,
      {duck_temporal('visit_date')} FROM e)
    SELECT visit_id, {', '.join(_TEMPORAL_NAMES)}, {duck_cycles()}, {DUCK_INTERACTIONS},
      {_duck_lags('WAITTIME', 'ORDER BY visit_ts, visit_id')},
      {_duck_rolling('WAITTIME', 'ORDER BY visit_ts, visit_id')} FROM f""",
)
def all_features(spark, sf):
    out = enrich.all_features(
        derived(spark, sf),
        value_cols=["WAITTIME"],
        order_by=["visit_ts", "visit_id"],
        holidays=HOLIDAYS,
    )
    names = [f"WAITTIME{s}" for s in ROLLING]
    lags = [f"WAITTIME_lag{n}" for n in (1, 3, 7, 14)]
    return rounded(out, *CYCLES, *names).select(
        "visit_id", *_TEMPORAL_NAMES, *CYCLES, *INTERACTIONS, *lags, *names
    )


@query(
    "sentiment_label",
    with_views("v_posts")
    + """ SELECT post_id, CASE WHEN sentiment_polarity > 0.3 THEN 'positive'
      WHEN sentiment_polarity < -0.3 THEN 'negative' ELSE 'neutral' END AS label FROM v_posts""",
)
def sentiment_label(spark, sf):
    return view(spark, sf, "v_posts").select(
        "post_id", ms.sentiment_label("sentiment_polarity").alias("label")
    )


@query(
    "sentiment_category",
    with_views("v_posts")
    + """ SELECT post_id, CASE WHEN sentiment_polarity > -1 AND sentiment_polarity <= -0.3 THEN 'Negative'
      WHEN sentiment_polarity > -0.3 AND sentiment_polarity <= 0.3 THEN 'Neutral'
      WHEN sentiment_polarity > 0.3 AND sentiment_polarity <= 1 THEN 'Positive' END AS category FROM v_posts""",
)
def sentiment_category(spark, sf):
    return view(spark, sf, "v_posts").select(
        "post_id", ms.sentiment_category("sentiment_polarity").alias("category")
    )


@query(
    "pct_change",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.0
       ELSE round((l_tax - l_discount) / l_discount * 100, 6) END AS pct FROM lineitem""",
)
def pct_change(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(ms.pct_change("l_discount", "l_tax")).alias("pct")
    )


@query(
    "human_number",
    """SELECT o_orderkey, CASE WHEN n >= 1000000 THEN printf('%.1fM', n / 1000000.0::DOUBLE)
       WHEN n >= 1000 THEN printf('%.1fK', n / 1000.0::DOUBLE) ELSE CAST(n AS VARCHAR) END AS shown
       FROM (SELECT o_orderkey, o_orderkey * CAST(50 AS BIGINT) AS n FROM orders)""",
)
def human_number(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", ms.human_number(F.col("o_orderkey") * 50).alias("shown")
    )


@query(
    "parse_iso_ts",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '2024-06-01 00:00:00'
       ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS parsed FROM events""",
)
def parse_iso_ts(spark, sf):
    ts = F.col("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shown = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(iso)
    return table(spark, sf, "events").select(
        "event_id", text_time(dt.parse_iso_timestamp(shown, "2024-06-01 00:00:00")).alias("parsed")
    )


@query(
    "epoch_to_ts",
    "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS stamp FROM events",
)
def epoch_to_ts(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        "event_id", text_time(dt.epoch_to_timestamp(seconds)).alias("stamp")
    )
