"""Feed assembly: search terms, per-group limits, unions and per-source counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretide.operators.schema import col

# The default search terms.
HASHTAGS = ("#fluseason", "#ERwait", "#sicktoday", "#healthanxiety")
PHRASES = (
    "emergency room", "urgent care", "feel sick",
    "hospital wait", "flu symptoms", "covid symptoms",
)


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All rows of all feeds; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def match_queries(
    posts: DataFrame,
    hashtags: Sequence[str] = HASHTAGS,
    phrases: Sequence[str] = PHRASES,
    column: str = "text",
) -> DataFrame:
    """One row per post and matching term, with ``query_no`` and ``query``.

    Hashtags come first; a phrase is labelled in double quotes. The terms are
    plan constants, so there is no join: each post is tested where it lies.
    """
    low = F.lower(col(column))
    labels = [*hashtags, *[f'"{p}"' for p in phrases]]
    hits = [
        F.when(
            low.contains(term.lower()),
            F.struct(
                F.lit(i).alias("query_no"),
                F.lit(label).alias("query"),
                F.lit(i < len(hashtags)).alias("is_hashtag"),
            ),
        )
        for i, (term, label) in enumerate(zip([*hashtags, *phrases], labels, strict=True))
    ]
    return posts.withColumn("__hit", F.explode(F.array_compact(F.array(*hits)))).select(
        *[col(c) for c in posts.columns], "__hit.*"
    )


#: Spark cuts groups inside map tasks by itself up to this number of rows.
_CUT_BY_SPARK = 1_000
#: Parts of a group that are cut by themselves where Spark does not.
_SALTS = 64


def cut_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """``df`` without rows that cannot be among the first ``k`` of their group.

    Beyond the number up to which Spark does so in map tasks, each group is dealt out to parts by
    a hash of the rows' other columns, and each part keeps its own first ``k``; so a group of any
    size reaches the last step as at most ``k`` rows per part, and no task sorts it whole.
    """
    if k <= _CUT_BY_SPARK:
        return df
    dealt = df.withColumn("__salt", F.pmod(F.xxhash64(*[col(c) for c in df.columns if c not in keys and not df.schema[c].dataType.simpleString().startswith("map")]), F.lit(_SALTS)))
    part = Window.partitionBy(*[col(c) for c in keys], "__salt").orderBy(*order)
    return dealt.withColumn("__rn", F.row_number().over(part)).filter(F.col("__rn") <= k).drop("__rn", "__salt")


def limit_per_query(
    matches: DataFrame,
    hashtag_limit: int = 500,
    phrase_limit: int = 250,
    id_column: str = "tweet_id",
    date_column: str = "date",
) -> DataFrame:
    """Newest matches per term, up to the term's limit.

    Each map task keeps at most the limit per term before the shuffle (see :func:`cut_groups`).
    """
    order = [col(date_column).desc(), col(id_column).desc()]
    top = max(hashtag_limit, phrase_limit)
    matches = cut_groups(matches, ["query_no"], order, top)
    w = Window.partitionBy("query_no").orderBy(*order)
    ranked = matches.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= top)
    limit = F.when(F.col("is_hashtag"), F.lit(hashtag_limit)).otherwise(F.lit(phrase_limit))
    return ranked.filter(F.col("position") <= limit)


def newest_per_group(
    posts: DataFrame,
    group: str = "subreddit",
    k: int = 500,
    date_column: str = "date",
    id_column: str = "post_id",
) -> DataFrame:
    """The ``k`` newest rows per group, ties by id."""
    order = [col(date_column).desc(), col(id_column).asc()]
    w = Window.partitionBy(col(group)).orderBy(*order)
    posts = cut_groups(posts, [group], order, k)
    return posts.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def ingest_counts(feeds: Mapping[str, DataFrame | None]) -> DataFrame:
    """``(source, n)`` per feed, absent feeds 0, and a ``TOTAL`` row."""
    spark = next(f.sparkSession for f in feeds.values() if f is not None)
    names = spark.createDataFrame([(s,) for s in feeds], "source string")
    counts = [
        f.agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(s))
        for s, f in feeds.items()
        if f is not None
    ]
    per_source = names.join(union_feeds(counts), "source", "left").select(
        "source", F.coalesce("n", F.lit(0)).alias("n")
    )
    return per_source.rollup("source").agg(F.sum("n").alias("n")).select(
        F.coalesce("source", F.lit("TOTAL")).alias("source"), "n"
    )
