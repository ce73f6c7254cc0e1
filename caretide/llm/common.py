"""What the operators of this subpackage share: inputs, blocks, questions by bucket, components.

A *block* is a set of documents, chosen by a hash of the document, with a bounded number of bytes.
Blocks travel as a few compressed Arrow chunks instead of one row per word. A block asks a
*bucket* (the owner of a range of key hashes) about its distinct keys, packed into one binary per
bucket, and gets one packed answer back. Since each block asks about a key once, a key that holds
a third of all rows costs its bucket one entry per block.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretide.session import materialize

#: Characters that part words; every other character belongs to a word.
WORD_BREAKS = "\t\n\x0b\x0c\r "
_SPACES = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def words_of(text: str) -> list[str]:
    """The matches of ``[^\\x20\\x09-\\x0D]+``, in order."""
    return [w for w in text.translate(_SPACES).split(" ") if w] if not text.isascii() else _ascii_words(text)


def _ascii_words(text: str) -> list[str]:
    # str.split also parts at \x1c-\x1f, which are word characters here.
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in text.translate(_SPACES).split(" ") if w]
    return text.split()


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id BIGINT, text STRING`` (null text: empty) and the named further columns.

    Other columns are left out here, so their names cannot clash with an operator's own.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in extra],
    )


def text_hash(text: Column) -> Column:
    """128 bits of a text's SHA-256, by which texts are equated."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def count_blocks(docs: DataFrame, block_bytes: int, bucket_bytes: int) -> tuple[int, int]:
    """How many blocks and buckets the documents' bytes need.

    Small tables get a block per shuffle partition, and at most 64 buckets, as every block may
    ask every bucket.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = shuffle_parts(docs.sparkSession)
    return max(math.ceil(total / block_bytes), parts), max(math.ceil(total / bucket_bytes), min(parts, 64))


def packed_blocks(docs: DataFrame, n_blocks: int) -> DataFrame:
    """``block, payload``: the rows of each block in compressed Arrow chunks.

    The block depends on the row's own values only, so a recomputed task sends every row to the
    same block; the order within a block may differ and no operator relies on it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = table.column("block").to_numpy()
            order = np.argsort(keys, kind="stable")
            keys, table = keys[order], table.drop_columns(["block"]).take(pa.array(order))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate([[0], cuts]) if len(keys) else []
            for lo, hi in zip(starts, [*cuts, len(keys)], strict=False):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                    out.write_table(table.slice(lo, hi - lo).combine_chunks())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(keys[lo])], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    ["block", "payload"],
                )

    keyed = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
    return keyed.mapInArrow(pack, "block bigint, payload binary")


def unpack(group: pa.Table) -> Iterator[pa.Table]:
    """The chunks of a block, one table at a time."""
    for payload in group.column("payload"):
        yield pa.ipc.open_stream(payload.as_buffer()).read_all()
    release_memory()


def squeeze(values: np.ndarray) -> bytes:
    """A numeric array as compressed bytes."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(raw, dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """A sorted array of unsigned keys: differences compress, byte plane by byte plane."""
    keys = np.ascontiguousarray(keys, "<u8")
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return squeeze(steps.view(np.uint8).reshape(-1, 8).T)


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    planes = unsqueeze(data, np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """One 64-bit hash of two (splitmix64's finisher over a product sum)."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019) + b
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BREAK = np.zeros(256, bool)
_BREAK[list(WORD_BREAKS.encode())] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def release_memory() -> None:
    """Give freed memory back, as a Python worker lives on beside the next stages' tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves
        ctypes.CDLL(None).malloc_trim(0)


def small_slices(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of text, and at least one row, each."""
    done = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = done[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(done, before + limit, side="right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
    release_memory()


def word_digests(texts: pa.Array | pa.ChunkedArray, breaks: np.ndarray = _BREAK) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of all words of some texts, as two columns, text after text, and each
    text's number of words.

    Words are found on the column's bytes at once, as word breaks are single bytes of UTF-8. A
    word of up to 15 bytes is these bytes and its length, 128 bits that a permutation (a Feistel
    network) scrambles, so no two of them have the same digest; a longer word has a
    cryptographic hash.
    """
    if isinstance(texts, pa.ChunkedArray):
        parts = [word_digests(c, breaks) for c in texts.chunks]
        return np.concatenate([p[0] for p in parts] or [np.empty((0, 2), np.uint64)]), np.concatenate([p[1] for p in parts] or [np.empty(0, np.int64)])
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.empty((0, 2), np.uint64), np.zeros(len(texts), np.int64)
    word = ~breaks[data]
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    starts = np.flatnonzero(word & (new[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (new[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    counts = np.bincount(np.searchsorted(offsets, starts, side="right") - 1, minlength=len(texts))
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    digests = np.lib.stride_tricks.sliding_window_view(padded, 16)[starts].view("<u8").copy()
    short = np.minimum(sizes, 15)
    for half in (0, 1):
        digests[:, half] &= _FIRST_BYTES[np.clip(short - 8 * half, 0, 8)]
    digests[:, 1] |= short.astype(np.uint64) << np.uint64(56)
    low, high = digests[:, 0], digests[:, 1]
    for k in range(6):
        low, high = high, low ^ mix(high, k)
    digests = np.stack([low, high], axis=1)
    known: dict[bytes, bytes] = {}
    for i in np.flatnonzero(sizes > 15).tolist():
        word = data[starts[i] : ends[i]].tobytes()
        if (found := known.get(word)) is None:
            found = known[word] = blake2b(word, digest_size=16).digest()
        digests[i] = np.frombuffer(found, "<u8")
    return digests, counts.astype(np.int64)


#: Masks of the first 0 to 8 bytes of a word of eight.
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def word_hashes(texts: pa.Array | pa.ChunkedArray, breaks: np.ndarray = _BREAK) -> tuple[np.ndarray, np.ndarray]:
    """The first 64 bits of :func:`word_digests`."""
    digests, counts = word_digests(texts, breaks)
    return digests[:, 0].copy(), counts


def distinct_rows(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows: their order by the columns, where in it each distinct row begins, and the number of
    the distinct row at each place."""
    turn = np.argsort(columns[0])
    changed = [np.diff(c[turn], prepend=c[turn[:1]] + np.uint64(1)) != 0 for c in columns]
    if any((c & ~changed[0]).any() for c in changed[1:]):  # rows that only later columns tell apart
        turn = np.lexsort(columns[::-1])
        changed = [np.diff(c[turn], prepend=c[turn[:1]] + np.uint64(1)) != 0 for c in columns]
    new = np.logical_or.reduce(changed)
    return turn, np.flatnonzero(new), np.cumsum(new) - 1


def _powers(base: int, n: int) -> np.ndarray:
    if (base, n) not in _POWERS:
        with np.errstate(over="ignore"):
            _POWERS[base, n] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)
    return _POWERS[base, n]


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def by_bucket(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, start, end)`` over sorted keys; a bucket is a range of the upper 32 bits."""
    if not len(keys):
        return
    owner = ((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    starts = np.concatenate([[0], cuts])
    for lo, hi in zip(starts, [*cuts, len(keys)], strict=True):
        yield int(owner[lo]), int(lo), int(hi)


ASKED = "bucket bigint, block bigint, payload binary"
Answer = Callable[[list[bytes]], list[bytes]]


def asked(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int64()),
            "block": pa.array([r[1] for r in rows], pa.int64()),
            "payload": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


#: Blocks whose questions to a bucket meet in one group.
FAN = 512
Merge = Callable[[list[bytes]], bytes]
Split = Callable[[bytes, bytes, bytes], bytes]


def answered(questions: DataFrame, answer: Answer, merge: Merge, split: Split, n_blocks: int, fan: int = FAN) -> DataFrame:
    """Each bucket's answers to the blocks that asked it, in the form of the questions.

    Up to ``fan`` blocks ask a bucket directly. More of them first ask together: the questions of
    every ``fan`` consecutive blocks to a bucket become one by ``merge``, again until few are
    left, and ``split(question, merged question, merged answer)`` fans the answers out. So no
    group holds more than ``fan`` payloads, however many blocks ask about a common key.
    """

    def reply(group: pa.Table) -> pa.Table:
        return group.set_column(2, "payload", pa.array(answer([x.as_py() for x in group.column("payload")]), pa.binary()))

    if n_blocks <= fan:
        return questions.groupBy("bucket").applyInArrow(reply, ASKED)

    def together(key: tuple, group: pa.Table) -> pa.Table:
        return asked([(key[0].as_py(), key[1].as_py(), merge([x.as_py() for x in group.column("payload")]))])

    def apart(group: pa.Table, above: pa.Table) -> pa.Table:
        whole, replies = (_payloads(above, kind) for kind in (0, 1))
        out = [split(own.as_py(), whole, replies) for own in group.column("payload")]
        return group.select(["bucket", "block", "payload"]).set_column(2, "payload", pa.array(out, pa.binary()))

    stored = materialize(questions, "questions")
    hall = F.floor(F.col("block") / fan).cast("bigint")
    halls = materialize(stored.withColumn("hall", hall).groupBy("bucket", "hall").applyInArrow(together, ASKED), "questions")
    replies = answered(halls, answer, merge, split, math.ceil(n_blocks / fan), fan)
    above = halls.withColumn("kind", F.lit(0)).unionByName(replies.withColumn("kind", F.lit(1)))
    return stored.withColumn("hall", hall).groupBy("bucket", "hall").cogroup(above.withColumnRenamed("block", "hall").groupBy("bucket", "hall")).applyInArrow(apart, ASKED)


def _payloads(above: pa.Table, kind: int) -> bytes:
    (found,) = above.filter(pc.equal(above.column("kind"), kind)).column("payload").to_pylist()
    return found


def framed(parts: list[bytes]) -> bytes:
    """Several byte strings as one."""
    return b"".join([len(parts).to_bytes(4, "little"), *[len(p).to_bytes(8, "little") for p in parts], *parts])


def unframed(data: bytes) -> list[bytes]:
    count = int.from_bytes(data[:4], "little")
    sizes = np.frombuffer(data, "<u8", count, 4).tolist()
    out, at = [], 4 + 8 * count
    for size in sizes:
        out.append(data[at : at + size])
        at += size
    return out


def block_no(left: pa.Table) -> int:
    return left.column("block")[0].as_py() if left.num_rows else -1


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """``node, root``: the smallest node of each connected component of ``a BIGINT, b BIGINT``.

    Each round lowers every node's root to the smallest root among its neighbours, then jumps to
    the root's root; the rounds needed grow with the logarithm of the longest path. Each round
    is one written table in the shared folder. Nodes are held only if they have an edge.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, label)
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), label)
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        up = roots.select(F.col("node").alias("low"), F.col("root").alias("top"))
        new = materialize(lower.join(up, "low").select("node", F.col("top").alias("root"), (F.col("old") != F.col("top")).alias("moved")), label)
        if not new.filter("moved").take(1):
            return new.select("node", "root")
        roots = new.select("node", "root")
