"""Token counts that follow edits: a segment tree over the pre-tokens of each document."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.llm.common import small_slices
from caretide.llm.tokens import encoding, pretokens, read_ranks

#: Pre-tokens per leaf when a tree is built.
LEAF = 16
#: A boundary between pre-tokens depends on at most so many characters after it.
AHEAD = 4


class Counter(dict):
    """Token counts of pre-tokens, remembered for a task; forgets when it holds too many."""

    LIMIT = 200_000

    def __init__(self, ranks: dict[bytes, int]):
        self.encode = encoding(ranks)._encode_single_piece

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        count = self[word] = len(self.encode(word))
        return count


class CountTree:
    """A document's text and a binary tree of sums (characters, tokens) over runs of pre-tokens."""

    def __init__(self, text: str, counter: Counter, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.text, self.counter, self.encoded = text, counter, 0
        self._grow(*((chars, tokens) if chars is not None else self._leaves(pretokens(text))))

    def _leaves(self, words: list[str], n_leaves: int | None = None) -> tuple[list[int], list[int]]:
        self.encoded += len(words)
        counts = list(map(self.counter.__getitem__, words))
        n = n_leaves or max(1, -(-len(words) // LEAF))
        step = -(-len(words) // n) or 1
        cuts = [min(i * step, len(words)) for i in range(n + 1)]
        return [sum(map(len, words[a:b])) for a, b in zip(cuts, cuts[1:])], [sum(counts[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _grow(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = len(chars)
        self.width = 1 << max(self.leaves - 1, 0).bit_length()
        pad = [0] * (self.width - self.leaves)
        self.chars, self.tokens = [0] * self.width + chars + pad, [0] * self.width + tokens + pad
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        return self.chars[self.width : self.width + self.leaves], self.tokens[self.width : self.width + self.leaves]

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one, past the end) and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = min(node - self.width, self.leaves - 1)
        return (leaf, start) if leaf == node - self.width else (leaf, self.chars[1] - self.chars[self.width + leaf])

    def edit(self, at: int, cut: int, put: str) -> None:
        """Replace ``cut`` characters from ``at`` on by ``put``; both are limited to the text.

        Pre-tokens are split anew from a boundary so far before the edit that it cannot have
        moved, up to the first leaf after the edit that again starts where a pre-token does: the
        pattern never looks back, so nothing changes from there on. Only that region is encoded.
        """
        at = min(max(at, 0), len(self.text))
        cut = min(max(cut, 0), len(self.text) - at)
        first, start = self._leaf_at(max(at - AHEAD, 0))
        self.text = self.text[:at] + put + self.text[at + cut :]
        shift = len(put) - cut
        last, end = self._leaf_at(at + cut)
        end += self.chars[self.width + last]
        extra = 1
        while True:
            for _ in range(extra):
                if last + 1 < self.leaves:
                    last += 1
                    end += self.chars[self.width + last]
            whole = last + 1 == self.leaves
            words = pretokens(self.text[start : end + shift])
            if whole:
                stop, kept = last + 1, words
                break
            # Leaves of the region that may stay: those that start after the edit.
            starts, position = {}, end
            for leaf in range(last, first, -1):
                position -= self.chars[self.width + leaf]
                if position < at + cut:
                    break
                starts[position + shift] = leaf
            place, stop, kept = start, None, []
            for word in words:
                if place in starts and place <= end + shift - AHEAD:
                    stop = starts[place]
                    break
                kept.append(word)
                place += len(word)
            if stop is not None:
                break
            extra *= 2
        self._replace(first, stop, kept)

    def _replace(self, first: int, stop: int, words: list[str]) -> None:
        """New sums for the leaves from ``first`` up to ``stop``, then for the nodes above them."""
        slots = stop - first
        chars, tokens = self._leaves(words, slots)
        if len(words) > 4 * LEAF * slots:  # too full: split the leaves
            old_chars, old_tokens = self.leaf_sums()
            self.encoded -= len(words)
            chars, tokens = self._leaves(words)
            self._grow(old_chars[:first] + chars + old_chars[stop:], old_tokens[:first] + tokens + old_tokens[stop:])
            return
        lo, hi = self.width + first, self.width + stop - 1
        self.chars[lo : hi + 1], self.tokens[lo : hi + 1] = chars, tokens
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            for node in range(lo, hi + 1):
                self._sum(node)


TREE = "n_tokens bigint, leaf_chars array<int>, leaf_tokens array<int>"
EDITS = "array<struct<at:bigint,cut:bigint,put:string>>"


def _per_document(docs: DataFrame, path: str, work, schema: str) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for batch in batches:
            for part in small_slices(batch):
                yield work(part, counter)

    return docs.mapInArrow(run, schema)


def _tree_columns(trees: list[CountTree]) -> list[pa.Array]:
    sums = [t.leaf_sums() for t in trees]
    ints = pa.list_(pa.int32())
    return [pa.array([t.n_tokens for t in trees], pa.int64()), pa.array([s[0] for s in sums], ints), pa.array([s[1] for s in sums], ints)]


def build_trees(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, text, n_tokens, leaf_chars, leaf_tokens``, and ``edits`` if the input has them.

    The leaves' sums are what has to be kept of a tree; inner sums are their totals. Null text
    counts as empty (one empty leaf); null and repeated ids and repeated rows have trees of their
    own; an empty table gives no rows; other columns are left out.
    """
    edits = [F.col("edits").cast(EDITS).alias("edits")] if "edits" in docs.columns else []
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *edits)

    def build(batch: pa.RecordBatch, counter: Counter) -> pa.RecordBatch:
        trees = [CountTree(t, counter) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, *_tree_columns(trees)], [*batch.schema.names, *(c.split()[0] for c in TREE.split(", "))])

    return _per_document(own, path, build, f"doc_id bigint, text string{', edits ' + EDITS if edits else ''}, {TREE}")


def apply_edits(trees: DataFrame, path: str) -> DataFrame:
    """Trees after their ``edits``, applied in order: ``doc_id, text, n_tokens_before, n_tokens,
    leaf_chars, leaf_tokens, n_edits, n_encoded``.

    ``edits`` is ``ARRAY<STRUCT<at, cut, put>>`` in code points of the text as it is when the edit
    comes; positions and lengths are limited to the text, null numbers count as 0, a null
    replacement as empty, null edits are skipped. ``n_encoded`` counts the pre-tokens that were
    encoded: those of the touched regions and their boundary context only.
    """

    def apply(batch: pa.RecordBatch, counter: Counter) -> pa.RecordBatch:
        done, counts = [], []
        for text, chars, tokens, edits in zip(*[batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "edits")], strict=True):
            tree = CountTree(text, counter, chars, tokens)
            edits = [e for e in edits or () if e]
            for e in edits:
                tree.edit(e["at"] or 0, e["cut"] or 0, e["put"] or "")
            done.append(tree)
            counts.append((len(edits), tree.encoded))
        names = ["doc_id", "text", "n_tokens_before", *(c.split()[0] for c in TREE.split(", ")), "n_edits", "n_encoded"]
        columns = [batch.column("doc_id"), pa.array([t.text for t in done], pa.string()), batch.column("n_tokens"), *_tree_columns(done)]
        columns += [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names)

    return _per_document(trees, path, apply, f"doc_id bigint, text string, n_tokens_before bigint, {TREE}, n_edits bigint, n_encoded bigint")
