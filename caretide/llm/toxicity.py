"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import WORD_BREAKS, documents, mix, release_memory, small_slices, squeeze, unsqueeze, word_hashes

#: Hashed features; the weights are one float each, so what is broadcast has this bound.
DIMENSIONS = 1 << 22
#: Labelled rows to learn from: those with the smallest id hashes.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
EPOCHS = 5
#: Per-coordinate learning rates and penalties of FTRL-proximal.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.01
_BREAKS = np.zeros(256, bool)
_BREAKS[list((WORD_BREAKS + "\"'.,;:!?()[]{}<>#*$%&|-_").encode())] = True


def features(texts: pa.Array, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts and the number of the text that has each: its words (in lower case,
    without punctuation), word pairs, and pairs with one word skipped, hashed to indexes."""
    words, counts = word_hashes(pc.utf8_lower(texts), _BREAKS)
    doc = np.repeat(np.arange(len(counts)), counts)
    grams = [(mix(words, 1), doc)]
    for step, tag in ((1, 2), (2, 3)):
        inside = doc[:-step] == doc[step:]
        grams.append((mix(mix(words[:-step], words[step:]), tag)[inside], doc[:-step][inside]))
    return (np.concatenate([g for g, _ in grams]) % np.uint64(dimensions)).astype(np.int64), np.concatenate([d for _, d in grams])


def ftrl(rows: list[tuple[np.ndarray, int]], dimensions: int = DIMENSIONS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the non-zero weights, and a bias, from ``(distinct features, label)`` rows, in order.

    McMahan et al.'s FTRL-proximal: each coordinate has its own learning rate, from its own sum of
    squared gradients, and is zero until its signal exceeds the L1 penalty. The bias is not
    penalised.
    """
    z, n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        signal = z[at]
        shrunk = np.sign(signal) * np.maximum(np.abs(signal) - np.where(at < dimensions, L1, 0), 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for found, label in rows:
            at = np.append(found, np.uint32(dimensions))
            w = weights(at)
            gradient = _logistic(w.sum()) - label
            squares = gradient * gradient
            sigma = (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += squares
    at = np.flatnonzero(np.abs(z[:-1]) > L1)
    return at, weights(at), float(weights(np.array([dimensions]))[0])


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> DataFrame:
    """``label, order, doc_id, size, found`` of a bounded sample of the labelled documents that may be learned from.

    The sample is drawn from ``labels`` first, so it is broadcast; each document's distinct
    features are found where its text is read.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    sample = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(rows)
    # Repeated rows of a document are learned from once.
    chosen = documents(docs).join(F.broadcast(sample), "doc_id").select("label", "order", "doc_id", "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_slices(batch):
                found, doc = features(part.column("text"), dimensions)
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(1, part.num_rows))
                lists = [np.unique(x).astype("<u4") for x in np.split(found[order], cuts)]
                columns = [*[part.column(c) for c in ("label", "order", "doc_id")], pa.array(map(len, lists), pa.int64()), pa.array(map(squeeze, lists), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["label", "order", "doc_id", "size", "found"])

    return chosen.mapInArrow(find, "label int, order bigint, doc_id bigint, size bigint, found binary").dropDuplicates(["doc_id", "found"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, float]:
    """``(indexes, weights, bias)`` of the non-zero weights: at most ``dimensions`` of them.

    FTRL learns row by row, so one task sees the whole, bounded sample (a row has at most
    ``dimensions`` features). Without rows or without both labels the weights are empty.
    """

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("found", "ascending")])
        flat, ends = np.concatenate([unsqueeze(f.as_py(), "<u4") for f in group.column("found")]), np.cumsum(group.column("size").to_numpy())
        labels_of = group.column("label").to_pylist()
        del group
        at, weights, bias = ftrl(list(zip(np.split(flat, ends[:-1]), labels_of, strict=True)), dimensions)
        release_memory()
        return pa.table({"at": pa.array([squeeze(at.astype("<u4"))], pa.binary()), "weights": pa.array([squeeze(weights.astype("<f4"))], pa.binary()), "bias": pa.array([bias], pa.float64())})

    found = training_rows(docs, labels, rows, dimensions).groupBy(F.lit("all")).applyInArrow(learn, "at binary, weights binary, bias double").first()
    if not found:
        return np.empty(0, np.int64), np.empty(0), 0.0
    return unsqueeze(bytes(found["at"]), "<u4").astype(np.int64), unsqueeze(bytes(found["weights"]), "<f4"), found["bias"]


def held_out(doc_id):
    """Documents that are never learned from: one in five, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scorer(at: np.ndarray, weights: np.ndarray, bias: float, dimensions: int = DIMENSIONS) -> Callable[[pa.Array], np.ndarray]:
    """Scores of texts under the non-zero weights of a model of so many dimensions."""
    table = np.zeros(dimensions, np.float32)
    table[at] = weights

    def score(texts: pa.Array) -> np.ndarray:
        found, doc = features(texts, dimensions)
        weighty = table[found] != 0
        once = np.unique(doc[weighty] * dimensions + found[weighty])
        return _logistic(bias + np.bincount(once // dimensions, table[once % dimensions], len(texts)))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text, one row per input row.

    ``dimensions`` is the number of hashed features, of the training and of the scores. The classifier is learned from at most ``rows`` labelled rows whose crc32 of the id is no
    multiple of five; only the text is an input of a score. Its non-zero weights are broadcast.
    The score is the logistic of the bias and the weights of the text's distinct features.

    Null and empty texts get the bias's score; null and repeated ids and repeated rows are scored
    each on their own (a null id is not held out); null labels and labels of unknown documents
    are left out, of several labels of a document the largest counts; without labels every score
    is 0.5; an empty table gives no rows; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows, dimensions))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores_of = scorer(*model.value, dimensions)
        for batch in batches:
            for part in small_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(scores_of(part.column("text")))], ["doc_id", "held_out", "score"])

    rows_in = documents(docs).withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "text")
    scored = rows_in.mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> DataFrame:
    """The documents whose toxicity score, as in :func:`score_toxicity`, is below the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows, dimensions))

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores_of = scorer(*model.value, dimensions)
        for texts in parts:
            slices = small_slices(pa.RecordBatch.from_arrays([texts], ["text"]))
            yield pa.array(np.concatenate([scores_of(x.column("text")) for x in slices] or [np.empty(0)]))

    return docs.filter(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < THRESHOLD)
