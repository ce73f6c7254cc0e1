"""Byte-level BPE in which each distinct pre-token is encoded once for the whole corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import (
    ASKED,
    FAN,
    answered,
    asked,
    block_no,
    count_blocks,
    documents,
    packed_blocks,
    squeeze,
    unpack,
    unsqueeze,
)
from caretide.llm.tokens import encoding, pretokens, read_ranks

BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 16 << 20
#: No UTF-8 text holds this byte.
_END = b"\xff"


class Numbers(dict):
    """Numbers a block's distinct pre-tokens as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _word_lists(numbers: Numbers, n_buckets: int) -> dict[int, list[tuple[bytes, int]]]:
    """A block's distinct pre-tokens as sorted byte strings with their numbers, by the bucket that encodes them."""
    lists: dict[int, list[tuple[bytes, int]]] = {}
    for word, number in numbers.items():
        raw = word.encode()
        lists.setdefault(crc32(raw) % n_buckets, []).append((raw, number))
    for own in lists.values():
        own.sort()
    return lists


def _placed(group: pa.Table, numbers: Numbers) -> Iterator[tuple[pa.ChunkedArray, list[np.ndarray]]]:
    """The pre-tokens' numbers at their places in each text, chunk by chunk."""
    for chunk in unpack(group):
        words = [pretokens(t) for t in chunk.column("text").to_pylist()]
        yield chunk.column("doc_id"), [np.fromiter(map(numbers.__getitem__, w), np.uint32, len(w)) for w in words]


def _encoded_once(payloads: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """Ids of every asked pre-token; one that several blocks ask for is encoded once."""
    encode, known, out = encoding(ranks)._encode_single_piece, {}, []
    for payload in payloads:
        ids = []
        for word in _asked_words(payload):
            if (got := known.get(word)) is None:
                got = known[word] = encode(word) if word else []
            ids.append(got)
        out.append(_reply(ids))
    return out


def _asked_words(payload: bytes) -> list[bytes]:
    return unsqueeze(payload, np.uint8).tobytes().split(_END)


def _asked_together(payloads: list[bytes]) -> bytes:
    """The distinct pre-tokens of several questions."""
    words = sorted(set().union(*map(_asked_words, payloads)))
    return squeeze(np.frombuffer(_END.join(words), np.uint8))


def _split_ids(own: bytes, whole: bytes, reply: bytes) -> bytes:
    """A block's part of the answer to a common question."""
    ends, flat = _ids(reply)
    place = {w: k for k, w in enumerate(_asked_words(whole))}
    return _reply([flat[ends[k] : ends[k + 1]] for k in [place[w] for w in _asked_words(own)]])


def _reply(ids: list) -> bytes:
    sizes = np.array([len(x) for x in ids], "<u4")
    flat = np.fromiter((i for x in ids for i in x), "<u4", int(sizes.sum()))
    return len(p := squeeze(sizes)).to_bytes(8, "little") + p + squeeze(flat)


def _ids(reply: bytes) -> tuple[list[int], np.ndarray]:
    size = int.from_bytes(reply[:8], "little")
    sizes, flat = unsqueeze(reply[8 : 8 + size], "<u4"), unsqueeze(reply[8 + size :], "<u4")
    return [0, *np.cumsum(sizes, dtype=np.int64).tolist()], flat


def _known_ids(numbers: Numbers, replies: pa.Table, n_buckets: int) -> list[list[int]]:
    """Ids of each pre-token, by its number."""
    lists, ids = _word_lists(numbers, n_buckets), [[]] * len(numbers)
    for bucket, payload in zip(replies.column("bucket").to_pylist(), replies.column("payload"), strict=True):
        ends, flat = _ids(payload.as_py())
        flat = flat.tolist()
        for (_, number), (lo, hi) in zip(lists[bucket], pairwise(ends), strict=True):
            ids[number] = flat[lo:hi]
    return ids


def _encoded(docs: DataFrame, path: str, block_bytes: int, finish, schema: str, fan: int = FAN) -> DataFrame:
    """Texts are exchanged once, as blocks; a block's distinct pre-tokens go to the buckets that
    encode them, and ``finish`` puts the ids back in the order of the text."""
    docs = documents(docs)
    n_blocks, n_buckets = count_blocks(docs, block_bytes, BUCKET_BYTES)
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # bounded by the vocabulary
    blocks = packed_blocks(docs, n_blocks)

    def ask(group: pa.Table) -> pa.Table:
        numbers = Numbers()
        for _ in _placed(group, numbers):
            pass
        lists = _word_lists(numbers, n_buckets)
        return asked([(b, block_no(group), squeeze(np.frombuffer(_END.join([w for w, _ in own]), np.uint8))) for b, own in lists.items()])

    def place(group: pa.Table, replies: pa.Table) -> pa.Table:
        numbers = Numbers()
        placed = list(_placed(group, numbers))
        return finish(placed, _known_ids(numbers, replies, n_buckets), table.value)

    questions = blocks.groupBy("block").applyInArrow(ask, ASKED)
    replies = answered(questions, lambda payloads: _encoded_once(payloads, table.value), _asked_together, _split_ids, n_blocks, fan)
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(place, schema)


def encode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """``doc_id, ids ARRAY<INT>``: byte-level BPE ids of every whole text, without special tokens.

    Pre-tokens are exploded with their places in the block's texts; each distinct one is encoded
    once, in the bucket that owns it, and its ids are joined back and put in order. Between the
    steps travel only distinct pre-tokens and their ids, once per block.

    Null text counts as empty and has no ids; rows with null or repeated ids are encoded each on
    their own; an empty table gives no rows; other columns are ignored.
    """

    def finish(placed: list, ids_of: list[list[int]], _: dict) -> pa.Table:
        lists = [[i for w in text.tolist() for i in ids_of[w]] for _, texts in placed for text in texts]
        docs = pa.chunked_array([c for ids, _ in placed for c in ids.chunks], pa.int64())
        return pa.table({"doc_id": docs, "ids": pa.array(lists, pa.list_(pa.int32()))})

    return _encoded(docs, path, block_bytes, finish, "doc_id bigint, ids array<int>", fan)


def encode_digests(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the ids that :func:`encode` gives.

    The digests are of the decimal ids joined by commas, and of the bytes that the ids decode
    to by the token-byte table. Digests are taken where the ids are put in order, so that the
    ids themselves are not written.
    """

    def finish(placed: list, ids_of: list[list[int]], ranks: dict) -> pa.Table:
        token_bytes = {rank: token for token, rank in ranks.items()}
        shown = [",".join(map(str, ids)) for ids in ids_of]
        decoded = [b"".join([token_bytes[i] for i in ids]) for ids in ids_of]
        counts, ids_sha, bytes_sha = [], [], []
        for _, texts in placed:
            for text in texts:
                words = text.tolist()
                line = ",".join([shown[w] for w in words])
                counts.append(line.count(",") + bool(line))
                ids_sha.append(hashlib.sha256(line.encode()).hexdigest())
                bytes_sha.append(hashlib.sha256(b"".join([decoded[w] for w in words])).hexdigest())
        return pa.table(
            {
                "doc_id": pa.chunked_array([c for ids, _ in placed for c in ids.chunks], pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array(bytes_sha, pa.string()),
            }
        )

    return _encoded(docs, path, block_bytes, finish, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, decoded BINARY``: the bytes of ``ids`` by a join with the token-byte table.

    Ids are exploded with their places, joined to the table (one row per token of the vocabulary,
    so broadcast) and put together in order, row by row. Null or empty ids decode to no bytes;
    an id that is not in the table fails.
    """
    ranks = read_ranks(path)
    table = encoded.sparkSession.createDataFrame([(i, bytearray(t)) for t, i in ranks.items()], "id int, bytes binary")
    rows = encoded.select("doc_id", "ids", F.monotonically_increasing_id().alias("row"))
    looked = rows.select("doc_id", "row", F.posexplode_outer("ids").alias("place", "id")).join(F.broadcast(table), "id", "left")
    checked = looked.withColumn(
        "hex", F.when(F.col("id").isNotNull() & F.col("bytes").isNull(), F.raise_error(F.lit("unknown id")).cast("string")).otherwise(F.hex("bytes"))
    )
    parts = checked.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "hex"))).alias("parts"))
    return parts.select("doc_id", F.unhex(F.array_join("parts.hex", "")).alias("decoded"))
