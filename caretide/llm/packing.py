"""Packing of token sequences, balanced by their attention cost."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import documents, release_memory, small_slices
from caretide.llm.tokens import encoding, read_added, read_ranks

MAX_TOKENS = 1024
END_ID = 0
#: Documents packed together; their tails, shorter than a sequence each, are held by one task.
SHARD_DOCS = 16_384
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def balance(lengths: list[int], capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(item, start, length)``, as few as the tokens need.

    Items come in descending length. Each goes whole to the sequence of lowest cost among those
    with room for it; only if none has room, it is cut, and its parts fill the sequences of lowest
    cost that have any. So every sequence but the last ones is full.
    """
    total = sum(lengths)
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(math.ceil(total / capacity))]
    room = [capacity] * len(sequences)
    if total % capacity:
        room[-1] = total % capacity
    cost = [0.0] * len(sequences)
    # A heap for each number of free tokens, and over them a tree of the lowest (cost, sequence).
    none, leaves = (math.inf, -1), 1 << capacity.bit_length()
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    for s, free in enumerate(room):
        heaps[free].append((0.0, s))
    tree = [none] * leaves + [min(h, default=none) for h in heaps] + [none] * (leaves - capacity - 1)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(free: int) -> None:
        node = leaves + free
        tree[node] = heaps[free][0] if heaps[free] else none
        while node > 1:
            node //= 2
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def cheapest(least: int) -> int:
        """The sequence of lowest cost with room for so many tokens, or -1."""
        node, found = leaves + least, tree[leaves + least]
        while node > 1:
            if node % 2 == 0:
                found = min(found, tree[node + 1])
            node //= 2
        return found[1]

    def put(s: int, item: int, start: int, length: int) -> None:
        sequences[s].append((item, start, length))
        heapq.heappop(heaps[room[s]])
        update(room[s])
        room[s] -= length
        cost[s] += linear * length + quadratic * length * length
        if room[s]:
            heapq.heappush(heaps[room[s]], (cost[s], s))
            update(room[s])

    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[item]
        whole = cheapest(left) if left <= capacity else -1
        while left:
            s = whole if whole >= 0 else cheapest(1)
            part = min(left, room[s])
            put(s, item, start, part)
            start, left = start + part, left - part
    return sequences


def pack(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces of documents in sequences of at most ``max_tokens``, with balanced attention cost.

    A document is its text's subword ids (an added token of the vocabulary, wherever the text
    holds it, is one id) and ``end_id``. While it has ``max_tokens`` or more, its
    next ``max_tokens`` make a sequence of their own; the tails are dealt out to shards by a hash
    of the document, and each shard is packed by :func:`balance`: the estimated cost of a piece
    is linear plus quadratic in its length, descending tails go to the sequence of lowest cost
    with room. All sequences of a shard are full but one, so the padding is below ``max_tokens``
    per ``shard_docs`` documents.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row per
    piece. Null text counts as empty: one piece of one id. Repeated rows and null ids are packed
    each on their own; an empty table gives no rows; other columns are ignored.
    """
    docs = documents(docs)
    n_shards = max(math.ceil(docs.count() / shard_docs), 1)
    table = docs.sparkSession.sparkContext.broadcast((read_ranks(path), read_added(path)))  # bounded by the vocabulary
    tail = "doc_id bigint, shard bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, added = table.value
        core, contents = encoding(ranks, added)._core_bpe, set(added)

        def encode(text: str) -> list[int]:
            return core.encode(text, contents) if any(c in text for c in contents) else core.encode_ordinary(text)

        for batch in batches:
            for part in small_slices(batch):
                rows = []
                for doc, shard, text in zip(*[part.column(c).to_pylist() for c in ("doc_id", "shard", "text")], strict=True):
                    ids = np.array([*encode(text), end_id], "<u4")
                    n, raw = len(ids), ids.tobytes()
                    full = n // max_tokens * max_tokens
                    rows += [(doc, shard, s, max_tokens, crc32(raw[4 * s : 4 * (s + max_tokens)]), n, None) for s in range(0, full, max_tokens)]
                    if full < n:
                        rows.append((doc, shard, full, n - full, 0, n, raw[4 * full :]))
                yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in tail.split(", ")])

    def settle(group: pa.Table) -> pa.Table:
        # Order within the shard must not depend on the order of arrival.
        group = group.sort_by([(c, "ascending") for c in ("doc_id", "start", "length", "ids")])
        doc, shard, start, length, crc, tokens = (group.column(c).to_pylist() for c in ("doc_id", "shard", "start", "length", "ids_crc32", "doc_tokens"))
        ids = group.column("ids")
        tails = [i for i, valid in enumerate(ids.is_valid().to_pylist()) if valid]
        del group
        base, rows = shard[0] << 32 if shard else 0, []
        for k, sequence in enumerate(balance([length[i] for i in tails], max_tokens)):
            at = 0
            for item, cut, size in sequence:
                i = tails[item]
                raw = ids[i].as_py()[4 * cut : 4 * (cut + size)]
                rows.append((doc[i], start[i] + cut, size, crc32(raw), tokens[i], base + k, at))
                at += size
        k = len({r[5] for r in rows})
        for i in sorted(set(range(len(doc))).difference(tails)):
            rows.append((doc[i], start[i], length[i], crc[i], tokens[i], base + k, 0))
            k += 1
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        del ids
        release_memory()
        return pa.table({c.split()[0]: pa.array(v, pa.int64()) for c, v in zip(PIECES.split(", "), columns, strict=True)})

    dealt = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_shards)))
    return dealt.mapInArrow(pieces, tail).groupBy("shard").applyInArrow(settle, PIECES)
