"""Lexicon sentiment: tokens joined to a term table.

The lexicon is an input table ``(term, polarity, subjectivity)``, so the scores
are those of the given lexicon and of no particular library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretide.functions.measures import sentiment_label
from caretide.functions.text import WORD
from caretide.operators.schema import col, need, q
from caretide.session import broadcast_if_small

NEGATION_FACTOR = -0.5


def tokens(text: Column) -> Column:
    """Lowercased words (letters, digits, underscore, apostrophe)."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"([{WORD}']+)"), F.lit(1))


def sentiment_scores(
    df: DataFrame,
    text: str,
    id_column: str,
    lexicon: DataFrame,
    negations: Sequence[str] = (),
    intensifiers: dict[str, float] | None = None,
) -> DataFrame:
    """``(id, polarity, subjectivity)`` for texts with at least one lexicon word.

    The score is the mean over the lexicon words of the text. A word right after a
    negation counts ``-0.5`` times, one right after an intensifier that many times
    (kept within [-1, 1]). The words of a text are summed where the text lies, so
    only one small row per text is shuffled.
    """
    need(lexicon, ["term", "polarity", "subjectivity"])
    words = F.col("__w")
    looks_back = bool(negations or intensifiers)
    if looks_back:
        pairs = F.transform(
            words, lambda w, i: F.struct(w.alias("term"), F.get(words, i - 1).alias("before"))
        )
        each = F.inline(pairs)
    else:
        each = F.explode(words).alias("term")
    word_rows = (
        df.select(col(id_column), tokens(col(text)).alias("__w"))
        .select(col(id_column), each)
        .join(broadcast_if_small(lexicon.select("term", "polarity", "subjectivity")), "term")
    )
    factor = F.lit(1.0)
    for word, strength in (intensifiers or {}).items():
        factor = F.when(F.col("before") == word, F.lit(float(strength))).otherwise(factor)
    if negations:
        factor = F.when(F.col("before").isin(*negations), F.lit(NEGATION_FACTOR)).otherwise(factor)
    polarity = F.col("polarity")
    if looks_back:
        polarity = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), polarity * factor))
    # Rounded so that a score on a label bound does not depend on summation order.
    return word_rows.groupBy(id_column).agg(
        F.round(F.avg(polarity), 9).alias("polarity"),
        F.round(F.avg("subjectivity"), 9).alias("subjectivity"),
    )


def score_sentiment(
    df: DataFrame,
    text: str,
    id_column: str,
    lexicon: DataFrame,
    prefix: str = "sentiment_",
    **how,
) -> DataFrame:
    """Add (or replace) polarity, subjectivity and label.

    A text without lexicon words scores 0 and is neutral.
    """
    key = F.concat_ws(" ", F.xxhash64(col(text)), F.crc32(col(text).cast("binary")))
    texts = df.select(col(text).alias("__text"), key.alias("__key")).filter("__text is not null").dropDuplicates(["__key"])
    scores = sentiment_scores(texts, "__text", "__key", lexicon, **how).select(
        "__key", F.col("polarity").alias("__p"), F.col("subjectivity").alias("__s")
    )
    polarity = F.coalesce("__p", F.lit(0.0))
    # The score belongs to the text: rows that share an id, or have none, keep their own.
    added = {
        f"{prefix}polarity": polarity,
        f"{prefix}subjectivity": F.coalesce("__s", F.lit(0.0)),
        f"{prefix}label": sentiment_label(polarity),
    }
    return df.withColumn("__key", key).join(scores, "__key", "left").select(
        *[col(c) for c in df.columns if c not in added], *[v.alias(n) for n, v in added.items()]
    )


def sentiment_summary(
    df: DataFrame, polarity: str = "sentiment_polarity", label: str = "sentiment_label"
) -> DataFrame:
    """One row: mean and sample deviation of polarity, rows per label."""
    value = F.col(polarity)
    return df.agg(
        F.avg(value).alias("mean_polarity"),
        F.stddev_samp(value).alias("std_polarity"),
        *[
            F.count_if(F.col(label) == name).alias(f"{name}_count")
            for name in ("positive", "negative", "neutral")
        ],
    )
