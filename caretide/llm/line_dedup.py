"""Removal of lines that an earlier document has too, by pairwise alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretide.llm.common import _BASE, _powers, mix, release_memory, text_hash
from caretide.session import materialize

#: A line is rare if at most this share of the distinct texts has it. Rare ones lead to partners
#: before frequent ones do; no result depends on it.
RARE_SHARE = 0.1
#: A common block is deleted if its lines have so many characters together.
MIN_CHARS = 40
#: Lines that stay are aligned with so many first texts of their keys, before all of them.
WIDTHS = (8, 64)
_LAST = (1 << 63) - 1


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matching positions of two line lists, increasing in both.

    Equal lines at both ends match. Of the lines that are unique in both remaining parts, the
    longest run that keeps its order is anchored; the parts between anchors are aligned likewise.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        in_a, in_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        where = {line: j for j, line in enumerate(b[blo:bhi], blo) if in_b[line] == 1 and in_a[line] == 1}
        anchors = _increasing([(i, where[line]) for i, line in enumerate(a[alo:ahi], alo) if line in where])
        if anchors:
            for (i, j), (k, m) in zip([(alo - 1, blo - 1), *anchors], [*anchors, (ahi, bhi)], strict=True):
                todo.append((i + 1, k, j + 1, m))
            out += anchors
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second members increase."""
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before.append(last[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            last.append(n)
        else:
            tails[at], last[at] = j, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def common_blocks(later: list[int], earlier: list[int], sizes: list[int], min_chars: int = MIN_CHARS) -> list[int]:
    """Lines of the later document in aligned blocks: runs that are adjacent in both documents."""
    out, run = [], []
    for i, j in [*patience(later, earlier), (-1, -1)]:
        if run and (i, j) != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(sizes[k] for k, _ in run) >= min_chars:
                out += [k for k, _ in run]
            run = []
        run.append((i, j))
    return out


def line_table(docs: DataFrame) -> DataFrame:
    """``did, th, hashes, sizes``: each document's id (null: last), text hash, line hashes and line lengths."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("did"), text_hash(text).alias("th"), F.split(text, "\n", -1).alias("lines"))
    return lines.select("did", "th", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("lines", lambda x: F.length(F.trim(x))).alias("sizes"))


def line_keys(hashes: pa.ListArray, sizes: pa.ListArray, min_chars: int = MIN_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, line, key``: the keys by which each line of each text is found, in order of texts.

    A key is the hash of a smallest run of lines that holds the line and has ``min_chars``
    characters, so a line of that length is its own key and a shorter or blank one has a key for
    each way to reach it. A common block with that line has one of these runs within it, so two
    texts with such a block share a key of each of its lines.
    """
    counts = sizes.value_lengths().to_numpy(zero_copy_only=False)
    lines, chars = (np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int64) for x in (hashes, sizes))
    text, n = np.repeat(np.arange(len(counts)), counts), len(lines)
    begins = (np.cumsum(counts) - counts)[text]
    ends = begins + counts[text]
    done = np.concatenate([[0], np.cumsum(chars)])
    # The last line before each that is not blank.
    filled = np.concatenate([[-1], np.maximum.accumulate(np.where(chars > 0, np.arange(n), -1))])
    size = 1 << max(n, 1).bit_length()
    up, down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines.view(np.uint64) * up[:n], dtype=np.uint64)])
    at, lo, before = np.arange(n), np.arange(n), np.full(n, n + 1)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.uint64))]
    while len(at):
        # The run from lo: up to min_chars characters, and at least up to the line itself.
        hi = np.maximum(np.searchsorted(done, done[lo] + min_chars), at + 1)
        new = (hi < before) & (hi <= ends[at])
        run = (sums[hi[new]] - sums[lo[new]]) * down[lo[new]]
        found.append((at[new], mix(run, (hi - lo)[new].astype(np.uint64))))
        further = (hi > at + 1) | (done[hi.clip(max=n)] - done[lo] < min_chars)
        at, lo, before = at[further], filled[lo[further]], np.minimum(hi, before)[further]
        inside = lo >= begins[at]
        at, lo, before = at[inside], lo[inside], before[inside]
    at, keys = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return text[at[order]], (at - begins[at])[order], keys[order].view(np.int64)


def shared_keys(texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``key, did, th, at, new, df, first``: lines by keys (:func:`line_keys`) that several texts have.

    ``df`` is the number of texts with the key, ``first`` the first of them, and ``new`` marks one
    row per key and text.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                text, at, keys = line_keys(part.column("hashes"), part.column("sizes"), min_chars)
                order = np.lexsort((at, keys, text))
                text, at, keys = text[order], at[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
                own = [part.column(c).take(pa.array(text)) for c in ("did", "th")]
                yield pa.RecordBatch.from_arrays([pa.array(keys), *own, pa.array(at, pa.int32()), pa.array(new)], ["key", "did", "th", "at", "new"])
        release_memory()

    rows = texts.select("did", "th", "hashes", "sizes").mapInArrow(find, "key bigint, did bigint, th binary, at int, new boolean")
    shared = rows.filter("new").groupBy("key").agg(F.count("*").alias("df"), F.min(F.struct("did", "th")).alias("first")).filter("df > 1")
    # Stored, so that the join reads plain exchanges, whose hot partitions Spark splits.
    return materialize(rows.join(materialize(shared, "shared"), "key"), "held")


def aligned_lines(texts: DataFrame, rare_share: float = RARE_SHARE, min_chars: int = MIN_CHARS) -> DataFrame:
    """``th, removed``: the lines that alignment with any earlier text deletes from each text.

    A line can only be deleted by an earlier text that shares a key with it. Each is aligned with
    the first such text (of its rare keys, then of all); lines that stay go on to the first 8, the
    first 64 and at last to all earlier texts that have one of their keys. So the result is that of
    all pairs, while a line in a third of all texts costs many pairs only where the first texts
    with it do not align. A pair is aligned once.
    """
    held = shared_keys(texts, min_chars)
    later = texts.select("th", "hashes", "sizes")
    earlier = texts.select(F.col("th").alias("earlier"), F.col("hashes").alias("earlier_hashes"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("hashes", "earlier_hashes", "sizes")]
            found = [common_blocks(*(x.as_py() for x in row), min_chars) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("th"), pa.array(found, pa.list_(pa.int32()))], ["th", "lines"])

    limit = max(texts.count() * rare_share, 2)
    left = held.filter(F.col("first.th") != F.col("th"))
    lost, done = None, None
    for width, most in ((1, limit), (1, None), *((w, None) for w in WIDTHS), (None, None)):
        if width == 1:
            linked = left.filter(F.col("df") <= most) if most else left
            pairs = linked.select("th", F.col("first.th").alias("earlier"))
        else:
            partners = held.filter("new").select("key", F.struct("did", "th").alias("partner"), "df").join(left.select("key").distinct(), "key", "left_semi")
            if width:
                first = Window.partitionBy("key").orderBy("partner")
                partners = partners.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= width)
            partners = materialize(partners.select("key", "partner"), "partners")
            pairs = left.select("key", "did", "th").join(partners, "key").filter(F.col("partner") < F.struct("did", "th")).select("th", F.col("partner.th").alias("earlier"))
        pairs = pairs.distinct() if done is None else pairs.distinct().join(done, ["th", "earlier"], "left_anti")
        pairs = materialize(pairs, "pairs")
        aligned = pairs.join(later, "th").join(earlier, "earlier").select("th", "hashes", "earlier_hashes", "sizes").mapInArrow(align, "th binary, lines array<int>")
        found = materialize(aligned.select("th", F.explode("lines").alias("at")).distinct(), "lost")
        lost, done = (found, pairs) if lost is None else (lost.union(found), done.union(pairs))
        if width is None:
            break
        # All earlier texts of a key were partners if it has so few.
        tried = width + 1 if most is None else 0
        left = materialize(left.filter(F.col("df") > tried).join(found, ["th", "at"], "left_anti"), "left")
        if not left.take(1):
            break
    return lost.groupBy("th").agg(F.collect_set("at").alias("removed"))


def repeated_lines(docs: DataFrame, rare_share: float = RARE_SHARE, min_chars: int = MIN_CHARS) -> DataFrame:
    """``th, first_did, removed``: per text that loses lines or has copies, its first document and
    the numbers of the lines that the first document loses. Later copies lose all lines."""
    table = materialize(line_table(docs), "lines")
    texts = materialize(table.groupBy("th").agg(F.min("did").alias("did"), F.count_distinct("did").alias("copies"), F.first("hashes").alias("hashes"), F.first("sizes").alias("sizes")), "texts")
    removed = aligned_lines(texts, rare_share, min_chars)
    long = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b) >= min_chars
    joined = texts.select("th", F.col("did").alias("first_did"), ((F.col("copies") > 1) & long).alias("copied")).join(removed, "th", "left")
    return joined.filter(F.col("copied") | (F.size("removed") > 0))


def without_repeated_lines(docs: DataFrame, rare_share: float = RARE_SHARE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with ``text`` less repeated lines, and ``n_lines, n_removed`` beside it.

    Earlier and later go by ``doc_id``, then by text hash. A document is aligned by patience diff
    on line hashes, and aligned blocks (runs adjacent in both) of at least ``min_chars`` characters
    are deleted from it. What goes is what alignment with every earlier document deletes; partners
    are found by shared lines and only as many are aligned as it takes (:func:`aligned_lines`).
    Alignment is on the input texts. A later exact copy of a text of that length loses all lines.

    Lines are compared by 64-bit hashes and are parted by line feeds; blank lines
    have no characters of their own but may lie in a block. Null text counts as empty. Rows that repeat id and text count as one
    document; documents with null ids come last. Columns of the input are kept, whatever their
    names (a column of the name ``n_lines`` or ``n_removed`` keeps its values, and the count is
    left out); an empty table gives no rows.
    """
    out = _cut(docs, rare_share, min_chars)
    added = [F.col(c) for c in ("n_lines", "n_removed") if c not in docs.columns]
    return out.select("row.*", *added)


def _cut(docs: DataFrame, rare_share: float, min_chars: int) -> DataFrame:
    """``row, n_lines, n_removed``: the caller's columns as one, so that their names meet no other, with the new text."""
    lost = repeated_lines(docs, rare_share, min_chars)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("whole"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("did"))

    @F.pandas_udf("string")
    def keep(texts: pd.Series, removed: pd.Series) -> pd.Series:
        def rest(text: str, gone) -> str:
            if gone is None or not len(gone):
                return text
            out = set(map(int, gone))
            return "\n".join([line for i, line in enumerate(text.split("\n")) if i not in out])

        return pd.Series([rest(t, r) for t, r in zip(texts, removed, strict=True)], index=texts.index, dtype=object)

    copy = F.coalesce(F.col("copied") & (F.col("did") != F.col("first_did")), F.lit(False))
    joined = rows.withColumn("th", text_hash(F.col("whole"))).join(lost, "th", "left").withColumn("copy", copy)
    n_lines = F.size(F.split("whole", "\n", -1)).cast("bigint")
    n_removed = F.when(F.col("copy"), n_lines).otherwise(F.greatest(F.coalesce(F.size("removed"), F.lit(0)), F.lit(0)).cast("bigint"))
    new = F.when(F.col("copy"), "").otherwise(keep("whole", "removed"))
    return joined.select(F.col("row").withField("text", new).alias("row"), n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def drop_repeated_lines(docs: DataFrame, rare_share: float = RARE_SHARE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without repeated lines; ``n_chars``, if there, follows the text.

    Documents of which nothing but white space is left go; those that lost no line stay. Null
    text becomes empty; rows that repeat id and text are cut alike; other columns are kept,
    whatever their names; an empty table gives no rows.
    """
    out = _cut(docs, rare_share, min_chars)
    out = out.filter((F.col("n_removed") == 0) | (F.trim(F.translate("row.text", "\n\t\r", "")) != "")).select("row.*")
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
