"""Quality rules and a modified Kneser-Ney bigram model over subword ids, counted by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import (
    WORD_BREAKS,
    count_blocks,
    mix,
    packed_blocks,
    small_slices,
    squeeze,
    squeeze_sorted,
    unpack,
    unsqueeze,
    unsqueeze_sorted,
    word_hashes,
    words_of,
)
from caretide.llm.substrings import grams
from caretide.llm.tokens import encoding, read_ranks
from caretide.operators.quantiles import grouped_quantiles
from caretide.session import materialize

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_SHARE = 20, 8, 30

#: Bands: documents further than so many interquartile ranges from their language's quartiles go.
BAND_WIDTH = 3.0
BLOCK_BYTES, BUCKET_BYTES = 12 << 20, 64 << 20
#: Context of a text's first id.
START = 0xFFFF

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
PACKED = "doc_id bigint, lang string, " + BASE


def repeated_words(texts: pa.Array, window: int = REPEAT_WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Each text's number of words, and of words inside windows that occur twice or more in the
    text, the first occurrence included."""
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    runs = grams(words, window)
    at = np.flatnonzero(doc[: len(runs)] == doc[window - 1 : window - 1 + len(runs)])
    _, inverse, times = np.unique(mix(runs[at], doc[at]), return_inverse=True, return_counts=True)
    at = at[times[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return counts, np.bincount(doc[np.cumsum(cover)[:-1] > 0].astype(np.int64), minlength=len(counts))


def base_features(texts: pa.Array) -> list[np.ndarray | list[int]]:
    """Columns of the base rules, in the order of ``BASE``."""
    n_words, n_repeat = repeated_words(texts)
    chars, symbols, dup = [], [], []
    for text in texts.to_pylist():
        lines = [x for x in text.split("\n") if words_of(x)] if "\n" in text else []
        chars.append(len(text) - sum(map(text.count, WORD_BREAKS)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        dup.append(len(lines) - len(set(lines)))
    return [n_words, chars, symbols, dup, n_repeat]


def _measured(docs: DataFrame, path: str) -> DataFrame:
    """Base features and subword ids of each text, computed once, where the text is read."""
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # bounded by the vocabulary

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(table.value)._core_bpe.encode_ordinary
        names = ["doc_id", "lang", *[c.split()[0] for c in BASE.split(", ")], "text"]
        for batch in batches:
            for part in small_slices(batch):
                base = [pa.array(c, pa.int64()) for c in base_features(part.column("text"))]
                ids = [np.array(encode(t), "<u2").tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), *base, pa.array(ids, pa.binary())], names)

    if max(table.value.values()) >= START:
        raise ValueError("the vocabulary needs ids below 65535")
    # The ids take the text's place, as blocks are dealt out by doc_id and text.
    return docs.mapInArrow(measure, PACKED + ", text binary")


def _bigrams(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Keys (context above word), document number and language number of all bigrams of a chunk."""
    ids = [np.frombuffer(x.as_py(), "<u2") for x in chunk.column("text")]
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate(ids).astype(np.uint64) if ids else np.empty(0, np.uint64)
    before = np.concatenate([[START], flat[:-1]]).astype(np.uint64) if len(flat) else flat
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = START
    langs = chunk.column("lang").to_pylist()
    names = sorted(set(langs), key=lambda x: (x is None, x))
    number = {x: i for i, x in enumerate(names)}
    of_doc = np.array([number[x] for x in langs], np.int64)
    return (before << np.uint64(16)) | flat, np.repeat(np.arange(len(ids)), sizes), of_doc, names


def _block_bigrams(group: pa.Table) -> dict[str | None, tuple[np.ndarray, np.ndarray]]:
    """``{language: (sorted keys, counts)}`` of a block."""
    parts: dict[str | None, list] = {}
    for chunk in unpack(group):
        keys, doc, of_doc, names = _bigrams(chunk)
        lang = of_doc[doc] if len(doc) else np.empty(0, np.int64)
        for i, name in enumerate(names):
            own = keys[lang == i]
            if len(own):
                parts.setdefault(name, []).append(np.unique(own, return_counts=True))
    return {name: _summed([k for k, _ in own], [c for _, c in own]) for name, own in parts.items()}


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return values, np.bincount(inverse, np.concatenate(counts), len(values)).astype(np.int64)


def _owner(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """A bucket holds all bigrams of its contexts."""
    return (mix(keys >> np.uint64(16), 7) % np.uint64(n_buckets)).astype(np.int64)


COUNTS = "lang string, bucket bigint, block bigint, keys binary, counts binary"


def _lang_rows(lang, bucket, **columns) -> dict:
    return {"lang": pa.array(lang, pa.string()), "bucket": pa.array(bucket, pa.int64())} | columns


def _discounts(n: list[int]) -> list[float]:
    """Chen and Goodman's discounts for counts one, two, and three or more; n: counts of counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k + 1 - (k + 1) * y * n[k + 1] / n[k] if n[k] else (k + 1) / 2 for k in range(3)] if n[0] else [0.5, 1.0, 1.5]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)]


def _shard_stats(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    words, contexts = np.unique(keys & np.uint64(0xFFFF), return_counts=True)
    return words, contexts, [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _log_probs(keys: np.ndarray, counts: np.ndarray, continuation: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    """Interpolated modified Kneser-Ney of a shard's bigrams; all bigrams of a context are in one shard."""
    context, first, inverse = np.unique(keys >> np.uint64(16), return_index=True, return_inverse=True)
    del first
    total = np.bincount(inverse, counts, len(context))
    cut = discounts[np.minimum(counts, 3) - 1]
    spare = np.bincount(inverse, cut, len(context)) / total
    low = continuation[(keys & np.uint64(0xFFFF)).astype(np.int64)]
    return np.log(np.maximum(counts - cut, 0) / total[inverse] + spare[inverse] * low)


def bigram_model(questions: DataFrame) -> DataFrame:
    """``lang, bucket, keys, counts, log_probs``: the model, in sorted hash arrays per bucket.

    Blocks' bigram counts are summed per bucket. Continuation counts (in how many contexts an id
    follows) and counts of counts are summed over buckets per language and joined back.
    """

    def total(group: pa.Table) -> pa.Table:
        keys, counts = _summed([unsqueeze_sorted(x.as_py()) for x in group.column("keys")], [unsqueeze(x.as_py(), "<i8") for x in group.column("counts")])
        one = group.slice(0, 1)
        return pa.table({"lang": one.column("lang"), "bucket": one.column("bucket"), "keys": pa.array([squeeze_sorted(keys)], pa.binary()), "counts": pa.array([squeeze(counts)], pa.binary())})

    shards = questions.groupBy("lang", "bucket").applyInArrow(total, "lang string, bucket bigint, keys binary, counts binary")

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("lang", "keys", "counts")], strict=True):
                words, contexts, n = _shard_stats(unsqueeze_sorted(keys), unsqueeze(counts, "<i8"))
                item = np.concatenate([words.astype(np.int64), [-1, -2, -3, -4]])
                value = np.concatenate([contexts, n]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(item), pa.string()), pa.array(item), pa.array(value)], ["lang", "item", "n"])

    def tabulate(group: pa.Table) -> pa.Table:
        # At most one row per id of the vocabulary, and four counts of counts.
        item, n = group.column("item").to_numpy(), group.column("n").to_numpy()
        found = dict(zip(item[item < 0].tolist(), n[item < 0].tolist(), strict=True))
        continuation = np.zeros(START + 1)
        continuation[item[item >= 0]] = n[item >= 0]
        continuation /= max(continuation.sum(), 1)
        return pa.table(
            {
                "lang": group.column("lang").slice(0, 1),
                "continuation": pa.array([squeeze(continuation)], pa.binary()),
                "discounts": pa.array([_discounts([found.get(-k, 0) for k in (1, 2, 3, 4)])], pa.list_(pa.float64())),
            }
        )

    sums = shards.mapInArrow(stats, "lang string, item bigint, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    lower = sums.groupBy("lang").applyInArrow(tabulate, "lang string, continuation binary, discounts array<double>")
    joined = shards.alias("s").join(lower.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang"))).select("s.*", "continuation", "discounts")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for keys, counts, low, cut in zip(*[batch.column(c).to_pylist() for c in ("keys", "counts", "continuation", "discounts")], strict=True):
                probs = _log_probs(unsqueeze_sorted(keys), unsqueeze(counts, "<i8"), unsqueeze(low, "<f8"), np.array(cut))
                out.append(squeeze(probs.astype("<f4")))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("lang", "bucket", "keys", "counts")], pa.array(out, pa.binary())], ["lang", "bucket", "keys", "counts", "log_probs"])

    return joined.mapInArrow(weigh, "lang string, bucket bigint, keys binary, counts binary, log_probs binary")


def score_documents(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Base features and ``log_perplexity`` (per subword id; null without ids) of each document."""
    n_blocks, n_buckets = count_blocks(docs, block_bytes, BUCKET_BYTES)
    blocks = packed_blocks(_measured(docs, path), n_blocks)

    def ask(group: pa.Table) -> pa.Table:
        block, rows = group.column("block")[0].as_py(), []
        for lang, (keys, counts) in _block_bigrams(group).items():
            owner = _owner(keys, n_buckets)
            for bucket in np.unique(owner).tolist():
                own = owner == bucket
                rows.append((lang, bucket, squeeze_sorted(keys[own]), squeeze(counts[own])))
        return pa.table(
            _lang_rows(
                [r[0] for r in rows],
                [r[1] for r in rows],
                block=pa.array([block] * len(rows), pa.int64()),
                keys=pa.array([r[2] for r in rows], pa.binary()),
                counts=pa.array([r[3] for r in rows], pa.binary()),
            )
        )

    questions = blocks.groupBy("block").applyInArrow(ask, COUNTS)
    model = bigram_model(questions)

    def answer(asking: pa.Table, shard: pa.Table) -> pa.Table:
        keys, probs = unsqueeze_sorted(shard.column("keys")[0].as_py()), unsqueeze(shard.column("log_probs")[0].as_py(), "<f4")
        replies = [squeeze(probs[np.searchsorted(keys, unsqueeze_sorted(x.as_py()))]) for x in asking.column("keys")]
        return pa.table({"lang": asking.column("lang"), "bucket": asking.column("bucket"), "block": asking.column("block"), "probs": pa.array(replies, pa.binary())})

    answers = questions.groupBy("lang", "bucket").cogroup(model.groupBy("lang", "bucket")).applyInArrow(answer, "lang string, bucket bigint, block bigint, probs binary")

    def judge(group: pa.Table, replies: pa.Table) -> pa.Table:
        known = {}
        for lang, (keys, _) in _block_bigrams(group).items():
            owner, probs = _owner(keys, n_buckets), np.zeros(len(keys))
            known[lang] = keys, owner, probs
        for lang, bucket, payload in zip(*[replies.column(c).to_pylist() for c in ("lang", "bucket", "probs")], strict=True):
            _, owner, probs = known[lang]
            probs[owner == bucket] = unsqueeze(payload, "<f4")
        out = []
        for chunk in unpack(group):
            keys, doc, of_doc, names = _bigrams(chunk)
            lang, logs = of_doc[doc] if len(doc) else np.empty(0, np.int64), np.zeros(len(keys))
            for i, name in enumerate(names):
                own = lang == i
                if own.any():
                    logs[own] = known[name][2][np.searchsorted(known[name][0], keys[own])]
            size = np.bincount(doc, minlength=chunk.num_rows)
            mean = -np.bincount(doc, logs, chunk.num_rows) / np.maximum(size, 1)
            log_perplexity = pa.array(mean, pa.float64(), mask=size == 0)
            out.append(chunk.drop_columns(["text"]).append_column("n_tokens", pa.array(size, pa.int64())).append_column("log_perplexity", log_perplexity))
        return pa.concat_tables(out)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, PACKED + ", n_tokens bigint, log_perplexity double")


def quality_rules(docs: DataFrame, path: str, band_width: float = BAND_WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Base features of every document, its perplexity, and whether it is kept.

    A modified Kneser-Ney bigram model over subword ids is counted on the whole table, one per
    language. Each language's bands are its quartiles of log perplexity plus and minus
    ``band_width`` interquartile ranges; documents above or below are rejected, as are those that
    fail the base rules (fewer than 20 words, or over 30 % of words in repeated windows).

    Returns ``doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_tokens,
    log_perplexity, lower, upper, base_failed, kept``, one row per input row. Null text counts as
    empty (it fails the base rules); a null language is a language of its own; null and repeated
    ids and repeated rows are judged each on their own; an empty table gives no rows; other
    columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    scored = materialize(score_documents(own, path, block_bytes), "perplexity")
    # Exact, so that no verdict hangs on how the rows were dealt out.
    quartiles = grouped_quantiles(scored, ["lang"], "log_perplexity", [0.25, 0.75])
    first, third = (F.max(F.when(F.col("p") == p, F.col("value"))) for p in (0.25, 0.75))
    reach = (third - first) * band_width
    bands = quartiles.groupBy(F.col("lang").alias("band_lang")).agg((first - reach).alias("lower"), (third + reach).alias("upper"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    joined = scored.join(bands, F.col("lang").eqNullSafe(F.col("band_lang")), "left").drop("band_lang")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
