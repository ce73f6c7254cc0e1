"""Any number of search terms found in one pass over each text, by an automaton.

The automaton (Aho and Corasick) runs over UTF-8 bytes: a state is the longest beginning of a
term that the bytes read so far end with. It is packed into plain arrays, and many pieces of text
are taken through it side by side, one byte of each at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.operators.schema import col
from caretide.session import materialize

#: Bytes that an automaton may take; a larger table of terms is cut into several.
MAX_BYTES = 64 << 20
#: Bytes of text that go through the automaton as one lane.
_LANE = 1_024
#: Bytes of text that are searched at once, however many rows Spark hands over.
_SLAB = 4 << 20
#: Ends of terms that are kept before they are reduced to different ones.
_PENDING = 1 << 20
#: Bytes and rows of matches that are handed back at once.
_OUT_BYTES, _OUT_ROWS = 8 << 20, 1 << 16


@dataclass
class Automaton:
    """``step[state * classes + class]`` is the next state; ``found`` lists what ends at a state.

    ``kind`` maps a byte to its class (0: in no term). ``term`` is the number of the term that a
    state spells, or -1, and ``shorter`` the next state whose term also ends here, or -1.
    """

    kind: np.ndarray
    classes: int
    step: np.ndarray
    term: np.ndarray
    shorter: np.ndarray
    longest: int

    @classmethod
    def of(cls, terms: list[bytes]) -> Automaton:
        """The automaton of different, non-empty terms."""
        used = sorted(set(b"".join(terms)))
        kind = np.zeros(256, np.int64)
        kind[used] = np.arange(1, len(used) + 1)
        classes = len(used) + 1
        children: list[dict[int, int]] = [{}]
        spelled: list[int] = [-1]
        for number, term in enumerate(terms):
            state = 0
            for c in kind[np.frombuffer(term, np.uint8)].tolist():
                if (following := children[state].get(c)) is None:
                    following = children[state][c] = len(children)
                    children.append({})
                    spelled.append(-1)
                state = following
            spelled[state] = number
        n = len(children)
        step, fail = np.zeros((n, classes), np.int32), [0] * n
        shorter, term_of = [-1] * n, spelled
        level = [0]
        while level:  # by length, so that a state's fallback is finished before it
            below = []
            for state in level:
                step[state] = step[fail[state]] if state else 0
                for c, following in children[state].items():
                    fail[following] = int(step[state, c]) if state else 0
                    back = fail[following]
                    shorter[following] = back if term_of[back] >= 0 else shorter[back]
                    step[state, c] = following
                    below.append(following)
            level = below
        longest = max(map(len, terms), default=0)
        return cls(kind, classes, step.ravel(), np.array(term_of, np.int64), np.array(shorter, np.int64), longest)

    def matches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of text and term number, each once, for the terms that a text contains."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        # A lane reads on into the next by as much as a term that begins in it may need.
        lanes = -(-lengths // _LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        start = np.repeat(offsets[:-1], lanes) + (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * _LANE
        stop = np.minimum(start + _LANE + max(self.longest - 1, 0), offsets[owner + 1]) if len(owner) else start
        turn = np.argsort(start - stop, kind="stable")  # longest first, so that lanes end from the back
        owner, start, size = owner[turn], start[turn], (stop - start)[turn]
        hit = (self.term >= 0) | (self.shorter >= 0)
        state, pairs, pending = np.zeros(len(owner), np.int64), [], 0
        active = len(owner)
        for k in range(int(size.max(initial=0))):
            active = int(np.searchsorted(-size[:active], -k, side="left"))
            state = self.step[state[:active] * self.classes + self.kind[data[start[:active] + k]]].astype(np.int64)
            ends = np.flatnonzero(hit[state])
            if len(ends):
                pairs.append(owner[ends] * len(self.term) + state[ends])
                pending += len(ends)
            if pending > _PENDING:
                pairs, pending = [np.unique(np.concatenate(pairs))], 0
        seen = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        text, state = np.divmod(seen, len(self.term))
        out: list[np.ndarray] = []
        while len(state):
            own = self.term[state] >= 0
            out.append(text[own] * len(self.term) + self.term[state[own]])
            text, state = text[self.shorter[state] >= 0], self.shorter[state][self.shorter[state] >= 0]
        return np.divmod(np.unique(np.concatenate(out)) if out else np.empty(0, np.int64), len(self.term))


def contained_terms(texts: DataFrame, terms: DataFrame, column: str = "text", term: str = "term", keep: Sequence[str] | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per text and term that it contains: the text's columns and the term's row as ``match``.

    ``keep`` names the columns wanted (all by default); the text itself is best left out where
    texts hold many terms, as every row repeats it.

    Terms and texts are compared as they are (lower both before if case shall not matter); empty
    and null terms match nothing, null texts contain nothing, a term that stands in several rows
    matches with each. Terms may overlap and lie within each other.

    The table of terms is measured first. While its automaton fits in ``max_bytes``, it is
    built once, broadcast, and each text is read once where it lies; no text is exchanged. A
    larger table is cut by a hash into parts that fit, and the texts are read once for each part.
    """
    usable = terms.filter(F.length(col(term)) > 0)
    listed = materialize(usable.select(col(term).alias("term"), F.struct(*[col(c) for c in terms.columns]).alias("match")), "terms")
    whole = F.octet_length("term") + F.coalesce(F.octet_length(F.to_json("match")), F.lit(0))
    sizes = listed.agg(F.sum(F.octet_length("term")).alias("terms"), F.sum(whole.cast("bigint")).alias("rows")).first()
    # A state per byte of the terms at most, with a next state of four bytes per class.
    digits = F.split(F.hex(F.encode("term", "utf-8")), "(?<=\\G..)")
    classes = 1 + listed.select(F.explode(F.array_distinct(digits)).alias("byte")).distinct().count()
    parts = max(1, math.ceil((sizes["terms"] or 0) * (4 * classes + 16) / max_bytes))
    row = F.struct(*[col(c) for c in (texts.columns if keep is None else keep)]).alias("row")
    view = texts.select(row, col(column).cast("string").alias("searched"))
    found = reduce(DataFrame.unionByName, [_found_in(view, listed, parts, k) for k in range(parts)])
    # A term that many texts hold must not be one task's: the rows of terms are broadcast if that is safe.
    matched = F.broadcast(listed) if (sizes["rows"] or 0) <= max_bytes else listed
    return found.join(matched, "term").select("row.*", "match")


def _runs(sizes: np.ndarray, most: int, rows: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``rows`` items and ``most`` bytes, or of one larger item."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(total, total[lo] + most, side="right")) - 1))
        yield lo, hi
        lo = hi


def _cut(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts take at most ``most`` bytes, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for lo, hi in _runs(sizes, most, max(len(sizes), 1)):
        yield batch.slice(lo, hi - lo)


def _search(automaton: Automaton, names: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, term`` for batches of ``row, searched``, in bounded pieces on the way in and out."""
    words = pa.array(names, pa.string())
    for batch in batches:
        for slab in _cut(batch, "searched", _SLAB):
            text, number = automaton.matches(slab.column("searched"))
            rows = slab.column("row")
            width = np.array([rows.slice(i, 1).nbytes for i in range(len(rows))], np.int64)
            for lo, hi in _runs(width[text], _OUT_BYTES, _OUT_ROWS):
                found = [rows.take(pa.array(text[lo:hi])), words.take(pa.array(number[lo:hi]))]
                yield pa.RecordBatch.from_arrays(found, ["row", "term"])


_PACKED = "kind binary, classes int, step binary, term binary, shorter binary, longest int, words array<string>"


def _packed(terms: pa.Table) -> pa.Table:
    """The automaton of a column of terms as one row, with the terms by number."""
    words = sorted(terms.column("term").to_pylist())
    a = Automaton.of([w.encode() for w in words])
    values = (a.kind.tobytes(), a.classes, a.step.tobytes(), a.term.tobytes(), a.shorter.tobytes(), a.longest, words)
    kinds = (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.string()))
    names = ("kind", "classes", "step", "term", "shorter", "longest", "words")
    return pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds, strict=True)})


def _found_in(view: DataFrame, listed: DataFrame, parts: int, part: int) -> DataFrame:
    """``row, term``: what the texts contain of one part of the terms."""
    own = listed.filter(F.pmod(F.xxhash64("term"), F.lit(parts)) == part).select("term").distinct()
    # Built in a task, as its tree takes many times the room of its arrays; the part was measured.
    built = own.groupBy(F.lit("all")).applyInArrow(_packed, _PACKED).first()
    if built is None:  # no terms
        return view.filter(F.lit(False)).select("row", F.lit("").alias("term"))
    shared = view.sparkSession.sparkContext.broadcast(tuple(built))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, classes, step, term, shorter, longest, names = shared.value
        wide = [np.frombuffer(part, np.int64) for part in (kind, term, shorter)]
        automaton = Automaton(wide[0], classes, np.frombuffer(step, np.int32), wide[1], wide[2], longest)
        yield from _search(automaton, names, batches)

    kind = view.schema["row"].dataType.simpleString()
    out = view.filter("searched IS NOT NULL").mapInArrow(search, f"row {kind}, term string")
    # Of several automata only one is held at a time.
    return out if parts == 1 else materialize(out, "found")
