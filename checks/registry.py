"""Views over the given tables and the two registries.

A view is written once; the few expressions that differ by engine are tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretide.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()

TEXT_TABLES = ("documents", "pages", "conversations")

_START = "TIMESTAMP '2024-01-01 00:00:00'"
# token: (Spark, DuckDB)
_TOKENS = {
    "{ts}": ("CAST(ts AS TIMESTAMP)", "ts"),
    "{vd}": ("date_format(ts,'MMddyyyy')", "strftime(ts,'%m%d%Y')"),
    "{pd}": (
        f"{_START} + make_dt_interval(CAST(doc_id % 30 AS INT), CAST(doc_id % 24 AS INT))",
        f"{_START} + to_days(CAST(doc_id % 30 AS INT)) + to_hours(CAST(doc_id % 24 AS INT))",
    ),
    "{td}": (
        f"{_START} + make_dt_interval(CAST(conv_id % 30 AS INT), CAST(turn AS INT))",
        f"{_START} + to_days(CAST(conv_id % 30 AS INT)) + to_hours(CAST(turn AS INT))",
    ),
    "{nd}": (
        f"{_START} + make_dt_interval(CAST(page_id % 15 * 2 AS INT))",
        f"{_START} + to_days(CAST(page_id % 15 * 2 AS INT))",
    ),
}

# The given tables hold no nulls, bad dates or odd codes, so the views add them.
VIEWS = {
    "v_visits": """
        SELECT event_id AS visit_id, {ts} AS visit_ts,
          CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN NULL ELSE {vd} END AS VDATE,
          CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((event_id*7) % 130 - 2 AS INT) END AS AGE,
          CAST(event_id % 2 + 1 AS INT) AS SEX,
          CASE WHEN event_id % 53 = 0 THEN 'xx' WHEN event_id % 50 = 0 THEN '2400'
               ELSE CAST(hour(ts)*100+minute(ts) AS VARCHAR(8)) END AS ARRTIME,
          CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS WAITTIME,
          value*3 + event_id % 60 AS LOS,
          CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(event_id % 5 + 1 AS INT) END AS IMMEDR,
          CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 7 + 1 AS INT) END AS PAYTYPER,
          concat(chr(9), ' ', event_type, '  ') AS DIAG1,
          CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS RFV1,
          CASE WHEN event_id % 250 = 0 THEN 1 ELSE 0 END AS LEFTBTRT,
          7 AS FLATCOL
        FROM {events}""",
    # Every visit, and the most urgent ones sent in twice.
    "v_extract": """
        SELECT VDATE, AGE, SEX, ARRTIME, WAITTIME, LOS, IMMEDR, PAYTYPER, DIAG1, RFV1, LEFTBTRT, FLATCOL
        FROM {v_visits}
        UNION ALL
        SELECT VDATE, AGE, SEX, ARRTIME, WAITTIME, LOS, IMMEDR, PAYTYPER, DIAG1, RFV1, LEFTBTRT, FLATCOL
        FROM {v_visits} WHERE IMMEDR = 1""",
    "v_posts": """
        SELECT CAST(doc_id AS VARCHAR(20)) AS post_id, source AS subreddit,
          concat(source, ' ', lang, ' ', CAST(n_chars % 97 AS VARCHAR(20))) AS title,
          CASE WHEN doc_id % 41 = 0 THEN '   ' WHEN doc_id % 43 = 0 THEN NULL ELSE text END AS text,
          {pd} AS date, CAST(n_chars % 1000 AS INT) AS score, CAST(n_chars % 50 AS INT) AS num_comments,
          (n_chars % 101) / 1e2 AS upvote_ratio,
          (doc_id % 201 - 100) / 1e2 AS sentiment_polarity
        FROM {documents}""",
    "v_tweets": """
        SELECT conv_id*100+turn AS tweet_id, concat('u', CAST(conv_id AS VARCHAR(20))) AS username,
          text, {td} AS date,
          CAST(length(text) % 100 AS INT) AS likes, CAST(length(text) % 10 AS INT) AS retweets,
          CAST(turn AS INT) AS replies, ((conv_id*8+turn) % 201 - 100) / 1e2 AS sentiment_polarity
        FROM {conversations}""",
    # Every second day only, so lags by row and by calendar differ.
    "v_news": """
        SELECT page_id, url, concat('Release ', CAST(page_id % 60 AS VARCHAR(20))) AS title,
          html AS content, {nd} AS date
        FROM {pages}""",
    "v_daily": """
        SELECT CAST(ts AS DATE) AS ds, count(*) AS visits, round(avg(value),6) AS y
        FROM {events} GROUP BY CAST(ts AS DATE)""",
    "v_orders_daily": """
        SELECT CAST(o_orderdate AS DATE) AS ds, count(*) AS visits, max(o_totalprice) AS y
        FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""",
}
_INPUTS = {
    "v_visits": ("events",), "v_extract": ("v_visits",), "v_posts": ("documents",),
    "v_tweets": ("conversations",), "v_news": ("pages",), "v_daily": ("events",),
    "v_orders_daily": ("orders",),
}

# Terms that occur in the given texts.
TERMS = ("the", "tion", "und", "que", "test")
AS_OF = "2024-01-31 12:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a Spark DataFrame."""
    text = VIEWS[name]
    for token, (on_spark, _) in _TOKENS.items():
        text = text.replace(token, on_spark)
    inputs = {
        n: view(spark, sf_dir, n) if n in VIEWS else table(spark, sf_dir, n) for n in _INPUTS[name]
    }
    return spark.sql(text, **inputs)


def with_views(*names: str) -> str:
    """``WITH`` list of views for the SQL check; append ``, more AS (...)`` or a query."""
    ordered: list[str] = []
    for name in names:
        for n in (*(i for i in _INPUTS[name] if i in VIEWS), name):
            if n not in ordered:
                ordered.append(n)
    parts = []
    for name in ordered:
        text = VIEWS[name]
        for token, (_, on_duck) in _TOKENS.items():
            text = text.replace(token, on_duck)
        for n in _INPUTS[name]:
            text = text.replace("{" + n + "}", n)
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts)


def query(name: str, sql: str | None = None):
    """Register a query and, if SQL can express it, its check."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; sums of doubles differ in their last bits."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: r(n, digits) for n in names})


def text_date(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def text_time(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def duck_date(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def duck_time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# The whitespace class of caretide.functions.text, spelled for the SQL check.
DUCK_SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
DUCK_WORD = r"\p{L}\p{N}_"


def duck_strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{DUCK_SPACE}]+|[{DUCK_SPACE}]+$', '', 'g')"


def duck_keywords(c: str, words=TERMS) -> str:
    tests = ", ".join(f"CASE WHEN contains(lower({c}), '{w}') THEN '{w}' END" for w in words)
    return f"coalesce(nullif(concat_ws(', ', {tests}), ''), 'none')"
