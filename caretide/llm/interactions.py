"""An audit of how filters interact: every order in which they can be applied, step by step."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretide.session import materialize

#: The letter of the filter against repeated texts, which is no condition on a single document.
REPEATED = "E"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions by letter: few words, few distinct words, many capitals, symbols."""
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals.cast("bigint") > 5 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(conditions: Mapping[str, Column], letters: str) -> Column:
    bits = [F.when(c, F.lit(1 << letters.index(k))).otherwise(F.lit(0)) for k, c in conditions.items()]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return total


def mask_cells(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of a part by the set of filters that they fail.

    Bit k of the mask is the k-th letter's filter. Texts are read once; what is exchanged are
    rows of a text's digest, an id and a mask. A text's smallest id is found by an aggregation
    that is merged in every task first, so a text in a third of all rows is no hot group.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    worded = read.withColumn("words", _words(F.col("text")))
    mask = _mask(text_filters(F.col("text"), F.col("words")), letters)
    rows = worded.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    facts = materialize(rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")), "facts")

    marks = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    )
    known = facts.filter("doc_id is not null").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    unknown = facts.filter("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})

    def counted(rows: DataFrame) -> DataFrame:
        sums = {"n": F.col("n"), "good": F.when(F.col("good"), F.col("n")).otherwise(0), "toxic": F.when(F.col("toxic"), F.col("n")).otherwise(0)}
        return rows.groupBy("part", "mask").agg(*[F.sum(c).cast("bigint").alias(k) for k, c in sums.items()])

    # The rows with a text's smallest id (several if the id is repeated) pass the filter against repeated texts.
    cell = F.struct("part", "mask", "good", "toxic", "n")
    by_id = known.groupBy("digest", "doc_id").agg(F.collect_list(cell).alias("cells"))
    first = by_id.groupBy("digest").agg(F.min_by("cells", "doc_id").alias("cells")).select(F.inline("cells"))
    columns = ["part", "mask", "good", "toxic", "n"]
    fails = F.lit(1 << letters.index(REPEATED))
    passing = counted(first.select(*columns).unionByName(unknown.select(*columns)))
    every = counted(known.select(*columns).unionByName(unknown.select(*columns))).withColumn("mask", F.col("mask") + fails)
    less = passing.select("part", (F.col("mask") + fails).alias("mask"), *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    both = passing.unionByName(every).unionByName(less)
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).filter("n > 0")


def _sum_where(condition: str, field: str = "n") -> str:
    return f"aggregate(c.cells, 0L, (total, x) -> total + IF({condition}, x.{field}, 0L))"


#: One level of the recursion adds an unused letter to every prefix and emits the new step's counts
#: from the part's mask cells and the bits that were applied before.
_AUDIT = f"""
WITH RECURSIVE letters AS (
    SELECT substring(:letters, CAST(id AS INT) + 1, 1) AS letter, shiftleft(1, CAST(id AS INT)) AS bit FROM range(length(:letters))
), steps (part, prefix, letter, step, applied, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
    SELECT part, '', '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
    UNION ALL
    SELECT s.part, concat(s.prefix, l.letter), l.letter, s.step + 1, s.applied | l.bit,
           {_sum_where("x.mask & (s.applied | l.bit) = 0")},
           {_sum_where("x.mask & s.applied = 0 AND x.mask & l.bit <> 0")},
           {_sum_where("x.mask & s.applied <> 0 AND x.mask & l.bit <> 0")},
           {_sum_where("x.mask = l.bit")},
           {_sum_where("x.mask & s.applied = 0 AND x.mask & l.bit <> 0", "good")},
           {_sum_where("x.mask & s.applied = 0 AND x.mask & l.bit <> 0", "toxic")}
    FROM steps s JOIN letters l ON s.applied & l.bit = 0 JOIN {{cells}} c ON s.part = c.part
)
SELECT * FROM steps LIMIT ALL
"""


def audit_orders(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every order of the filters, step by step, per part, from :func:`mask_cells`.

    A recursive query extends prefixes of letters by each unused letter, joins the part's mask
    cells and carries the applied bits; each of its levels emits the counts of that step. Orders
    with a common prefix share its rows: 325 a part for five letters. An order is then put
    together from its prefixes. ``shapley`` sums what a filter removes over all orders: a prefix
    stands for as many orders as its unused letters have.
    """
    spark = cells.sparkSession
    packed = materialize(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "cells")
    steps = spark.sql(_AUDIT, {"letters": letters}, cells=packed)
    steps = materialize(steps.filter("step > 0"), "steps")
    orders = F.factorial(F.lit(len(letters)) - F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = steps.filter(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    at = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    at = at.withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("step")))
    joined = at.join(steps.drop("step", "applied"), ["part", "prefix"]).join(shapley, ["part", "letter"])
    return joined.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of documents kept, removed, redundant and lost.

    A part is a source (null: the empty string). Five filters are applied in all 120 orders: a
    text fails A with under 50 words, B if under 65 % of its words are distinct, C if over 5 % of
    its characters are ``A-Z``, D if it holds a symbol, E if it is identical to the text of any
    smaller ``doc_id``. Per step: ``kept`` after it, ``removed`` by it, ``redundant`` (fails this
    filter, removed earlier), ``unique_fails`` (fails no other), ``good_lost`` and ``toxic_lost``
    (removed here, so labelled), and ``shapley`` of the step's filter.

    Null text counts as empty. A null id is larger than none and smaller than none; rows that
    repeat an id do not make each other fail E; an id with several labels has each of them. A
    part's counts are zero where nothing applies; an empty table gives no rows; other columns
    are ignored.
    """
    return audit_orders(mask_cells(docs, labels))
