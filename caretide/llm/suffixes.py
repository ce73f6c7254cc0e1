"""Removal of repeated byte strings by a suffix sort whose comparisons are made by hashes.

A *window* is ``length`` consecutive bytes of one text. Sorting all suffixes of a corpus in one
place is out of question, so the sort is dealt out: a window's *anchor* is the place of the
smallest gram hash within it, leftmost if tied. Equal windows have their anchor at the same
offset and with the same gram, so only windows with equal anchor grams are ever compared.
Neighbouring windows mostly share an anchor; such a *run* is one *piece* of text.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caretide.llm.common import (
    ASKED,
    answered,
    asked,
    block_no,
    by_bucket,
    count_blocks,
    distinct_rows,
    documents,
    framed,
    mix,
    packed_blocks,
    squeeze,
    squeeze_sorted,
    unframed,
    unpack,
    unsqueeze,
    unsqueeze_sorted,
)

LENGTH = 200
#: Bytes of the gram that stands for an anchor.
GRAM = 80
#: Different pieces with the same anchor gram that one task sorts; of a gram with more, windows are compared by digest.
HOT_PIECES = 2_048
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
#: Windows hashed, and bytes of pieces sorted, at a time.
_SLICE = 1 << 20

WHOLE, MIXED, HOT = 1, 2, 3

_VALUES = np.random.default_rng(13).integers(0, 2**64, 256, np.uint64)
_BASE = 0x2545F4914F6CDD1D


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        with np.errstate(over="ignore"):
            _POWERS[base] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)
    return _POWERS[base][:n]


_POWERS: dict[int, np.ndarray] = {}


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``P[i]``: the polynomial hash of the first i bytes, modulo 2^64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
    return sums


class SuffixSort:
    """Suffixes of ``data``, compared in their first ``length`` bytes.

    The common extension of two suffixes is found by a binary search over prefix hashes, so a
    comparison takes the logarithm of ``length`` steps; the byte after it decides.
    """

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.sums, self.up = prefix_hashes(data), _powers(_BASE, len(data) + 1)

    def same(self, a: np.ndarray, b: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[a + size] - self.sums[a]) * self.up[b] == (self.sums[b + size] - self.sums[b]) * self.up[a]

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at ``a`` is before, equal to or after the one at ``b``."""
        out = np.zeros(len(a), np.int8)
        differ = np.flatnonzero(~self.same(a, b, self.length))
        if not len(differ):
            return out
        a, b = a[differ], b[differ]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length - 1)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.same(a, b, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        out[differ] = np.where(self.data[a + low] < self.data[b + low], -1, 1)
        return out

    def sort(self, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of suffixes within each segment, and which equal the one before them.

        ``segment`` is sorted. A mergesort from below, all segments at once: a suffix's place in
        the merged run is its own place plus the number of the other run's suffixes before it.
        """
        n = len(at)
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        sizes = np.diff(first, append=n)
        start, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        turn, own = np.arange(n), np.arange(n) - start
        width, widest = 1, int(sizes.max(initial=0))
        while width < widest:
            pair = own // (2 * width) * (2 * width)
            left = own - pair < width
            low = np.where(left, np.minimum(pair + width, size), pair)
            high = np.where(left, np.minimum(pair + 2 * width, size), pair + width)
            begin = low
            open_ = np.flatnonzero(low < high)
            low, high = low.copy(), high.copy()
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                order = self.order(at[turn[start[open_] + middle]], at[turn[open_]])
                before = np.where(left[open_], order < 0, order <= 0)
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            place = start + own - np.where(left, 0, width) + (low - begin)
            merged = np.empty_like(turn)
            merged[place] = turn
            turn, width = merged, 2 * width
        equal, ordered = self._verified(at[turn], segment)
        if not ordered.all():  # hashes collided: sort those segments by their bytes
            for s in np.unique(segment[~ordered]):
                lo, hi = np.searchsorted(segment, [s, s + 1])
                turn[lo:hi] = sorted(turn[lo:hi].tolist(), key=lambda i: self.data[at[i] : at[i] + self.length].tobytes())
            equal, _ = self._verified(at[turn], segment)
        return turn, equal

    def _verified(self, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By the bytes: which suffixes equal the one before them, and which are not before it."""
        equal, ordered = np.zeros(len(at), bool), np.ones(len(at), bool)
        if len(at) < 2:
            return equal, ordered
        windows = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        pairs = np.flatnonzero(segment[1:] == segment[:-1]) + 1
        for lo in range(0, len(pairs), 1 << 14):
            some = pairs[lo : lo + (1 << 14)]
            one, two = windows[at[some - 1]], windows[at[some]]
            differ = one != two
            where, rows = differ.argmax(1), np.arange(len(some))
            equal[some] = ~differ[rows, where]
            ordered[some] = one[rows, where] <= two[rows, where]
        return equal, ordered


def repeated_windows(pieces: list[bytes], keys: np.ndarray, anchors: np.ndarray, often: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece, which of its windows are found elsewhere too.

    ``pieces`` are different texts; windows are compared if their pieces have the same key and
    they have the anchor at the same offset. ``often`` tells pieces that stand at several places.
    """
    sizes = np.array([len(p) - length + 1 for p in pieces], np.int64)
    out = [np.full(n, flag) for n, flag in zip(sizes.tolist(), often.tolist(), strict=True)]
    turn = np.argsort(keys, kind="stable")
    sorted_keys = keys[turn]
    new = np.flatnonzero(np.diff(sorted_keys, prepend=sorted_keys[:1] + np.uint64(1))) if len(keys) else np.empty(0, np.int64)
    groups = [g for g in np.split(turn, new[1:]) if len(g) > 1]
    batch, held = [], 0
    for k, group in enumerate(groups):
        batch.append(group)
        held += sum(len(pieces[i]) for i in group)
        if held < _SLICE and k + 1 < len(groups):
            continue
        members = np.concatenate(batch)
        number = np.repeat(np.arange(len(batch)), [len(g) for g in batch])
        data = np.frombuffer(b"".join([pieces[i] for i in members]), np.uint8)
        lengths, counts = sizes[members] + length - 1, sizes[members]
        base = np.cumsum(lengths) - lengths
        item = np.repeat(np.arange(len(members)), counts)
        within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        segment = number[item] * length + (anchors[members][item] - within)
        by_segment = np.argsort(segment, kind="stable")
        item, within, segment = item[by_segment], within[by_segment], segment[by_segment]
        sort = SuffixSort(data, length)
        order, equal = sort.sort(base[item] + within, segment)
        hit = equal | np.concatenate([equal[1:], [False]])
        for i, w in zip(members[item[order[hit]]].tolist(), within[order[hit]].tolist(), strict=True):
            out[i][w] = True
        batch, held = [], 0
    return out


class Runs:
    """The windows of a block's texts in runs of neighbours with the same anchor."""

    def __init__(self, group: pa.Table, length: int, gram: int):
        self.ids, texts = [], []
        for chunk in unpack(group):
            self.ids += chunk.column("doc_id").to_pylist()
            texts += [t.encode() for t in chunk.column("text").to_pylist()]
        self.length, self.raw = length, b"".join(texts)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        del texts
        self.ends = np.cumsum(self.sizes)
        parts = [self._slice(lo, gram) for lo in range(0, len(self.raw) - length + 1, _SLICE)]
        # first window, anchor, key of each run; runs cut by the end of a slice are put together.
        first, anchor, key, last = (np.concatenate([p[k] for p in parts] or [np.empty(0, t)]) for k, t in enumerate((np.int64, np.int64, np.uint64, np.int64)))
        new = np.flatnonzero(np.diff(anchor, prepend=-1)) if len(anchor) else np.empty(0, np.int64)
        self.first, self.anchor, self.key = first[new], anchor[new], key[new]
        self.last = last[np.append(new[1:], len(last)) - 1] if len(new) else last

    def _slice(self, lo: int, gram: int) -> tuple[np.ndarray, ...]:
        length = self.length
        data = np.frombuffer(self.raw, np.uint8)[lo : lo + _SLICE + length - 1]
        sums = prefix_hashes(data)
        n = len(data) - gram + 1
        with np.errstate(over="ignore"):
            hashes = mix((sums[gram:] - sums[:-gram]) * _powers(pow(_BASE, -1, 1 << 64), n), 0)
        del sums
        lowest = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        have, span = 1, length - gram + 1
        while have < span:
            step = min(have, span - have)
            lowest, have = np.minimum(lowest[: len(lowest) - step], lowest[step:]), have + step
        anchor = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at = np.arange(lo, lo + len(anchor))
        inside = at + length <= self.ends[np.searchsorted(self.ends, at, side="right")]
        at, anchor = at[inside], anchor[inside]
        new = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = at[np.append(new[1:], len(at)) - 1] if len(new) else at
        # Smallest hashes are small: mixed again, they are dealt out evenly to the buckets.
        return at[new], anchor[new] + lo, mix(hashes[anchor[new]], 1), last

    def piece(self, run: int) -> bytes:
        return self.raw[self.first[run] : self.last[run] + self.length]

    def digests(self) -> np.ndarray:
        """128 bits of each run's piece."""
        found = [blake2b(self.raw[a:b], digest_size=16).digest() for a, b in zip(self.first.tolist(), (self.last + self.length).tolist(), strict=True)]
        return np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)

    def statuses(self, replies: list[bytes]) -> np.ndarray:
        """What the buckets say of each run's key."""
        parts = [unframed(r) for r in replies]
        keys = np.concatenate([unsqueeze_sorted(p[0]) for p in parts] or [np.empty(0, np.uint64)])
        said = np.concatenate([unsqueeze(p[1], np.uint8) for p in parts] or [np.empty(0, np.uint8)])
        if not len(keys):
            return np.zeros(len(self.key), np.uint8)
        turn = np.argsort(keys)
        keys, said = keys[turn], said[turn]
        near = np.minimum(np.searchsorted(keys, self.key), len(keys) - 1)
        return np.where(keys[near] == self.key, said[near], 0)

    def mixed_pieces(self, status: np.ndarray) -> tuple[dict[tuple[int, bytes], list[int]], list[tuple[int, bytes]]]:
        """Runs of each different piece whose key has several, and the pieces in order."""
        found: dict[tuple[int, bytes], list[int]] = {}
        for run in np.flatnonzero(status == MIXED).tolist():
            found.setdefault((int(self.key[run]), self.piece(run)), []).append(run)
        return found, sorted(found)

    def hot_windows(self, status: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All windows of runs with a hot key, and their digests."""
        hot = np.flatnonzero(status == HOT)
        counts = (self.last - self.first + 1)[hot]
        at = np.repeat(self.first[hot], counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        found = [blake2b(self.raw[a : a + self.length], digest_size=16).digest() for a in at.tolist()]
        return at, np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)


# Questions of the first round: keys with piece digests, and whether the piece stands at several places.


def _keys_asked(key: np.ndarray, digest: np.ndarray, often: np.ndarray) -> bytes:
    turn, first, number = distinct_rows(key, digest[:, 0], digest[:, 1])
    weight = np.bincount(number, 1 + often[turn], len(first)) if len(turn) else np.empty(0)
    rows = turn[first]
    return framed([squeeze_sorted(key[rows]), squeeze(digest[rows]), squeeze(weight > 1)])


def _read_keys(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, digest, often = unframed(payload)
    return unsqueeze_sorted(key), unsqueeze(digest, "<u8").reshape(-1, 2), unsqueeze(often, bool)


def _join_keys(payloads: list[bytes]) -> bytes:
    parts = [_read_keys(p) for p in payloads]
    return _keys_asked(*[np.concatenate([p[k] for p in parts]) for k in range(3)])


def _told(keys: np.ndarray, said: np.ndarray, own: np.ndarray) -> bytes:
    own = np.unique(own)
    near = np.searchsorted(keys, own)
    near[near == len(keys)] = 0
    good = keys[near] == own if len(keys) else np.zeros(len(own), bool)
    return framed([squeeze_sorted(own[good]), squeeze(said[near[good]] if len(keys) else np.empty(0, np.uint8))])


def _answer_keys(payloads: list[bytes], hot_pieces: int) -> list[bytes]:
    key, _, often = _read_keys(_join_keys(payloads))
    values, first, pieces = np.unique(key, return_index=True, return_counts=True)
    repeats = np.maximum.reduceat(often, first) if len(values) else np.empty(0, bool)
    said = np.where(pieces > hot_pieces, HOT, np.where(pieces > 1, MIXED, np.where(repeats, WHOLE, 0))).astype(np.uint8)
    values, said = values[said > 0], said[said > 0]
    return [_told(values, said, _read_keys(p)[0]) for p in payloads]


def _split_keys(own: bytes, _: bytes, reply: bytes) -> bytes:
    keys, said = unframed(reply)
    return _told(unsqueeze_sorted(keys), unsqueeze(said, np.uint8), _read_keys(own)[0])


# Questions of the second round: pieces to sort, and digests of single windows of hot grams.


def _pieces_asked(rows: list[tuple[int, bytes, int, bool]], digest: np.ndarray, often: np.ndarray) -> bytes:
    """``rows``: key, piece, anchor's offset and whether at several places, in order."""
    turn, first, number = distinct_rows(digest[:, 0], digest[:, 1])
    weight = np.bincount(number, 1 + often[turn], len(first)) if len(turn) else np.empty(0)
    columns = [np.array([r[k] for r in rows], t) for k, t in ((0, "<u8"), (2, "<u2"), (3, bool))]
    sizes = np.array([len(r[1]) for r in rows], "<u4")
    blob = np.frombuffer(b"".join([r[1] for r in rows]), np.uint8)
    return framed([squeeze(c) for c in (*columns, sizes, blob, digest[turn[first]], weight > 1)])


def _read_pieces(payload: bytes) -> tuple[list[tuple[int, bytes, int, bool]], np.ndarray, np.ndarray]:
    parts = unframed(payload)
    key, anchor, often, sizes = (unsqueeze(p, t).tolist() for p, t in zip(parts, ("<u8", "<u2", bool, "<u4"), strict=False))
    blob, at, rows = unsqueeze(parts[4], np.uint8).tobytes(), 0, []
    for k, a, o, n in zip(key, anchor, often, sizes, strict=True):
        rows.append((k, blob[at : at + n], a, o))
        at += n
    return rows, unsqueeze(parts[5], "<u8").reshape(-1, 2), unsqueeze(parts[6], bool)


def _join_rows(lists: list[list[tuple[int, bytes, int, bool]]]) -> list[tuple[int, bytes, int, bool]]:
    found: dict[tuple[int, bytes], tuple[int, bool]] = {}
    for rows in lists:
        for key, piece, anchor, often in rows:
            found[key, piece] = (anchor, often or (key, piece) in found)
    return [(*k, *found[k]) for k in sorted(found)]


def _join_pieces(payloads: list[bytes]) -> bytes:
    parts = [_read_pieces(p) for p in payloads]
    return _pieces_asked(_join_rows([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))


def _told_windows(rows: list, flags: dict[tuple[int, bytes], np.ndarray], digest: np.ndarray, shared: set[bytes]) -> bytes:
    bits = np.concatenate([flags[r[0], r[1]] for r in rows] or [np.empty(0, bool)])
    hits = np.array([d.tobytes() in shared for d in digest], bool)
    return framed([squeeze(np.packbits(bits)), squeeze(hits)])


def _flags_by_piece(rows: list, bits: np.ndarray, length: int) -> dict[tuple[int, bytes], np.ndarray]:
    out, at = {}, 0
    for key, piece, *_ in rows:
        n = len(piece) - length + 1
        out[key, piece] = bits[at : at + n]
        at += n
    return out


def _answer_pieces(payloads: list[bytes], length: int) -> list[bytes]:
    parts = [_read_pieces(p) for p in payloads]
    rows = _join_rows([p[0] for p in parts])
    keys, anchors, often = (np.array([r[k] for r in rows], t) for k, t in ((0, np.uint64), (2, np.int64), (3, bool)))
    found = repeated_windows([r[1] for r in rows], keys, anchors, often, length)
    flags = {(r[0], r[1]): f for r, f in zip(rows, found, strict=True)}
    _, digest, many = _read_pieces(_pieces_asked([], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])))
    shared = {d.tobytes() for d in digest[many]}
    return [_told_windows(p[0], flags, p[1], shared) for p in parts]


def _split_pieces(own: bytes, whole: bytes, reply: bytes, length: int) -> bytes:
    rows, digest, _ = _read_pieces(whole)
    bits, hits = unframed(reply)
    flags = _flags_by_piece(rows, np.unpackbits(unsqueeze(bits, np.uint8)).astype(bool), length)
    shared = {d.tobytes() for d in digest[unsqueeze(hits, bool)]}
    mine, own_digest, _ = _read_pieces(own)
    return _told_windows(mine, flags, own_digest, shared)


def _by_owner(keys: np.ndarray, n_buckets: int) -> dict[int, np.ndarray]:
    """The rows of each bucket's keys."""
    turn = np.argsort(keys, kind="stable")
    return {b: turn[lo:hi] for b, lo, hi in by_bucket(keys[turn], n_buckets)}


def drop_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_pieces: int = HOT_PIECES, block_bytes: int = BLOCK_BYTES, fan: int = 512
) -> DataFrame:
    """Each document without the bytes covered by strings of ``length`` bytes that occur elsewhere.

    A byte of the UTF-8 text goes if some window that covers it also starts anywhere else, in the
    same document or another one; windows are judged on the input and lie within one document.
    Returns ``doc_id, n_bytes, spans ARRAY<STRUCT<start, end>>, kept BINARY``: the maximal
    removed runs (end exclusive) and the remaining bytes, one row per input row.

    Texts are exchanged once, into blocks. A block asks the owner of each anchor gram about its
    runs' pieces by 128-bit digests. A gram whose pieces are all the same text repeats whole or
    not at all. The pieces of the other grams are sent to the owner, which sorts the suffixes
    that start at their windows: a mergesort in which two suffixes are compared by prefix hashes
    and binary search; neighbours are then verified byte by byte, and what a hash collision put
    in disorder is sorted by the bytes. A gram with more than ``hot_pieces`` different pieces
    would be a hot group; its windows are compared one by one by 128-bit digests, which any task
    may own.

    Null text counts as empty; null and repeated ids are kept (repeated rows repeat each other's
    bytes); texts shorter than a window lose nothing; an empty table gives no rows; other columns
    are ignored. A document must fit in a task's memory.
    """
    if not 0 < gram <= length:
        raise ValueError("a gram has 1 to length bytes")
    docs = documents(docs)
    n_blocks, n_buckets = count_blocks(docs, block_bytes, BUCKET_BYTES)
    blocks = packed_blocks(docs, n_blocks)

    def ask(group: pa.Table) -> pa.Table:
        runs, block = Runs(group, length, gram), block_no(group)
        digest = runs.digests()
        none = np.zeros(len(digest), bool)
        return asked([(b, block, _keys_asked(runs.key[r], digest[r], none[r])) for b, r in _by_owner(runs.key, n_buckets).items()])

    def questions(runs: Runs, status: np.ndarray):
        """By bucket: the pieces to ask about with their runs, and the hot windows."""
        found, order = runs.mixed_pieces(status)
        at, digest = runs.hot_windows(status)
        rows = [(*k, int(runs.anchor[found[k][0]] - runs.first[found[k][0]]), len(found[k]) > 1) for k in order]
        of_pieces = _by_owner(np.array([k[0] for k in order], np.uint64), n_buckets)
        of_windows = _by_owner(digest[:, 0], n_buckets)
        none = np.empty(0, np.int64)
        for bucket in sorted({*of_pieces, *of_windows}):
            which, windows = of_pieces.get(bucket, none), of_windows.get(bucket, none)
            yield bucket, [rows[i] for i in which], [found[order[i]] for i in which], at[windows], digest[windows]

    def ask_mixed(group: pa.Table, replies: pa.Table) -> pa.Table:
        runs, block = Runs(group, length, gram), block_no(group)
        status = runs.statuses([r.as_py() for r in replies.column("payload")])
        return asked([(b, block, _pieces_asked(rows, digest, np.zeros(len(digest), bool))) for b, rows, _, _, digest in questions(runs, status)])

    def cut(group: pa.Table, replies: pa.Table) -> pa.Table:
        runs = Runs(group, length, gram)
        rounds, buckets, payloads = (replies.column(c).to_pylist() for c in ("round", "bucket", "payload"))
        status = runs.statuses([p for r, p in zip(rounds, payloads, strict=True) if r == 1])
        second = {b: unframed(p) for r, b, p in zip(rounds, buckets, payloads, strict=True) if r == 2}
        n = len(runs.raw)
        cover = np.zeros(n + 1, np.int64)
        whole = status == WHOLE
        np.add.at(cover, runs.first[whole], 1)
        np.add.at(cover, runs.last[whole] + length, -1)
        for bucket, rows, places, at, digest in questions(runs, status):
            bits, hits = second[bucket]
            flags = _flags_by_piece(rows, np.unpackbits(unsqueeze(bits, np.uint8)).astype(bool), length)
            starts = [at[_of_distinct(digest, unsqueeze(hits, bool))]]
            for row, where in zip(rows, places, strict=True):
                hit = np.flatnonzero(flags[row[0], row[1]])
                starts += [runs.first[run] + hit for run in where] if len(hit) else []
            starts = np.concatenate(starts)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + length, -1)
        covered = np.cumsum(cover)[:n] > 0
        spans, kept, lo = [], [], 0
        data = np.frombuffer(runs.raw, np.uint8)
        for size in runs.sizes.tolist():
            own = covered[lo : lo + size]
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(data[lo : lo + size][~own].tobytes() if edges else runs.raw[lo : lo + size])
            lo += size
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(runs.ids, pa.int64()),
                "n_bytes": pa.array(runs.sizes),
                "spans": pa.array(spans, kind),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    own = blocks.groupBy("block")
    first = answered(own.applyInArrow(ask, ASKED), lambda p: _answer_keys(p, hot_pieces), _join_keys, _split_keys, n_blocks, fan)
    asked_again = own.cogroup(first.groupBy("block")).applyInArrow(ask_mixed, ASKED)
    second = answered(asked_again, lambda p: _answer_pieces(p, length), _join_pieces, lambda a, b, c: _split_pieces(a, b, c, length), n_blocks, fan)
    replies = first.selectExpr("*", "1 AS round").unionByName(second.selectExpr("*", "2 AS round"))
    return own.cogroup(replies.groupBy("block")).applyInArrow(cut, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def _of_distinct(digest: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Flags of distinct digests, in the order in which they are asked, for all rows."""
    turn, _, number = distinct_rows(digest[:, 0], digest[:, 1])
    out = np.zeros(len(digest), bool)
    out[turn] = hits[number]
    return out
