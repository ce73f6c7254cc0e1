"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretide.llm import bpe, interactions, jaccard, line_dedup, merkle, packing, perplexity, pii, sql, substrings, suffixes, token_counts, topk, toxicity

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_edits(docs: DataFrame) -> DataFrame:
    """Five edits of every document at places that depend on its id: replace, insert, delete."""
    kinds = [(5, "lang"), (0, " edited, 2024 "), (40, ""), (3, "'re  \n x"), (0, "source")]

    def edit(k: int, cut: int, put: str):
        put = F.col(put) if put in ("lang", "source") else F.lit(put)
        return F.struct(F.pmod(F.xxhash64("doc_id", F.lit(k)), F.length("text") + 1).alias("at"), F.lit(cut).cast("bigint").alias("cut"), put.alias("put"))

    return docs.withColumn("edits", F.array(*[edit(k, *kind) for k, kind in enumerate(kinds)]))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subword counts of every document before and after five edits, through its segment tree."""
    trees = token_counts.build_trees(with_edits(table(spark, sf_dir, "documents")), BYTE_BPE)
    return token_counts.apply_edits(trees, BYTE_BPE).select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), MULTI_BPE)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores")
    total = F.size("spans").cast("bigint").alias("n_spans")
    return found.select("doc_id", *counts, F.sha2(listed(of(*pii.BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), scores, total)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeated_passages(table(spark, sf_dir, "documents")).drop("kept_text")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against a copy in which a fifth of them is in lower case."""
    crc = F.crc32(F.col("doc_id").cast("bigint").cast("string"))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.audit(table(spark, sf_dir, "documents"), F.when(crc % 5 == 0, lower))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_suffix_dedup": op13_suffix_dedup,
}

#: The operators over texts have no SQL: their tests compare them with brute force instead.
ORACLES: dict[str, str] = {
    "op10_exact_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.row, q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_merkle_manifest": sql.MANIFEST,
    "op12_filter_interactions": sql.FILTERS,
}
