"""Random forests of two classes on large tables.

Spark ML's trainer sends every row through every tree again for each level. Trees only see a
row's bins, so rows with equal bins and label are one row with a count here, and a bag holds it
a Poisson number of times with that count as mean, as the sum of the rows' own draws would be.
Each task then grows whole trees. Bins, features drawn per node, the order of categories, gain,
leaves and pruning are those of Spark ML, and so is the model; its random draws are others.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from caretide.operators.schema import col
from caretide.session import materialize, scratch_path

#: Different binned rows that are sent to every task (16 bytes each).
MOST_ROWS = 8_000_000
#: Levels up to which the counts of all nodes of a level stay small.
MOST_DEPTH = 14
_CHUNK = 1 << 18
_EPSILON = float(np.finfo(float).eps)

_NODE = (
    "struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def fit_forest(
    df: DataFrame, inputs: Sequence[str], forest: RandomForestClassifier, most_rows: int = MOST_ROWS
) -> RandomForestClassificationModel | None:
    """The model of ``forest`` (trees, depth and seed of its own, else the defaults) on labels 0 and 1.

    ``df`` has the assembled features, ``inputs`` names their columns. None if the table has
    other labels, missing values, wide categories, or more than ``most_rows`` different binned
    rows, which are counted before any is gathered.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if forest.getMaxDepth() > MOST_DEPTH or not all(isinstance(kinds[c], NumericType | BooleanType) for c in inputs):
        return None
    nominal, most = _nominal(df, forest.getFeaturesCol()), forest.getMaxBins()
    xs = [f"x{i}" for i in range(len(inputs))]
    wanted = [col(c).cast("double").alias(x) for c, x in zip(inputs, xs, strict=True)]
    # Stored once: five passes follow.
    rows = materialize(df.select(*wanted, col(forest.getLabelCol()).cast("double").alias("y")), "rows")
    odd = F.coalesce(~F.col("y").isin(0.0, 1.0), F.lit(True))
    for x in xs:
        odd = odd | F.col(x).isNull() | F.isnan(x)
    if rows.filter(odd).limit(1).count():
        return None
    splits = _splits(rows, [i for i in range(len(xs)) if i not in nominal], most)
    bins = [nominal.get(i) or len(splits[i]) + 1 for i in range(len(xs))]
    if max(bins) > most or math.prod(bins) >= 1 << 61:
        return None
    key = F.lit(0).cast("bigint")
    for i, x in enumerate(xs):
        key = key * bins[i] + (F.col(x).cast("int") if i in nominal else _bin(F.col(x), splits[i]))
    binned = rows.select((key * 2 + F.col("y").cast("int")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    binned = materialize(binned, "binned")
    if binned.count() > most_rows:
        return None
    return _written(forest, _trees(binned, bins, splits, nominal, forest), df.sparkSession, len(xs))


def _nominal(df: DataFrame, features: str) -> dict[int, int]:
    """Categories by feature number, as the vector column's metadata name them."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", [])}
    return found | {a["idx"]: 2 for a in attrs.get("binary", [])}


def _splits(rows: DataFrame, plain: Sequence[int], most: int) -> dict[int, list[float]]:
    """Thresholds by continuous feature: between all values if they are few, else quantiles."""
    if not plain:
        return {}
    at = [k / most for k in range(1, most)]
    found = rows.agg(
        *[F.approx_count_distinct(f"x{i}").alias(f"n{i}") for i in plain],
        *[F.percentile_approx(f"x{i}", at, 10_000).alias(f"q{i}") for i in plain],
        *[F.max(f"x{i}").alias(f"m{i}") for i in plain],
    ).first()
    out = {i: sorted({v for v in found[f"q{i}"] if v < found[f"m{i}"]}) for i in plain}
    few = [i for i in plain if found[f"n{i}"] <= 2 * most]
    if few:
        sets = rows.agg(*[F.collect_set(f"x{i}").alias(f"v{i}") for i in few]).first()
        for i in few:
            values = sorted(sets[f"v{i}"])
            if len(values) <= most:
                out[i] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return out


def _bin(x: Column, splits: list[float], first: int = 0) -> Column:
    """The number of thresholds below ``x``, by halves."""
    if not splits:
        return F.lit(first)
    mid = len(splits) // 2
    above = _bin(x, splits[mid + 1 :], first + mid + 1)
    return F.when(x > splits[mid], above).otherwise(_bin(x, splits[:mid], first))


def _trees(binned: DataFrame, bins, splits, nominal, forest: RandomForestClassifier) -> DataFrame:
    """``(treeID, nodeData)``: the nodes of all trees; every task grows some of them whole."""
    spark, trees = binned.sparkSession, forest.getNumTrees()
    depth, seed = forest.getMaxDepth(), forest.getSeed() & (1 << 63) - 1
    table = binned.toArrow()
    order = np.argsort(table["key"].to_numpy(), kind="stable")
    held = spark.sparkContext.broadcast((table["key"].to_numpy()[order], table["n"].to_numpy()[order]))
    del table, order
    kinds = {i: nominal.get(i, 0) for i in range(len(bins))}

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = held.value
        x = np.empty((len(key), len(bins)), np.uint8 if max(bins) <= 256 else np.int32)
        rest = key >> 1
        for i in reversed(range(len(bins))):
            rest, x[:, i] = np.divmod(rest, bins[i])
        y = (key & 1).astype(np.int8)
        del rest
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                nodes = grow_tree(x, y, n, bins, kinds, splits, depth, [seed, tree])
                yield pa.RecordBatch.from_pylist(
                    [{"treeID": tree, "nodeData": json.dumps(node)} for node in nodes],
                    pa.schema([("treeID", pa.int32()), ("nodeData", pa.string())]),
                )

    tasks = min(trees, 4 * spark.sparkContext.defaultParallelism)
    grown = spark.range(0, trees, 1, tasks).mapInArrow(grow, "treeID int, nodeData string")
    return grown.select("treeID", F.from_json("nodeData", _NODE).alias("nodeData"))


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(-1)
    share = counts / np.maximum(total, 1e-300)[..., None]
    return np.where(total > 0, 1 - (share * share).sum(-1), 0.0)


def grow_tree(x, y, n, bins, kinds, splits, depth: int, seed) -> list[dict]:
    """One tree, as Spark ML stores its nodes, on binned rows ``x`` that stand for ``n`` rows each."""
    rng = np.random.default_rng(seed)
    size = x.shape[1]
    drawn, width, sizes = math.ceil(math.sqrt(size)), max(bins), np.array(bins)
    ordered = np.array([not kinds[i] for i in range(size)])
    w = rng.poisson(n)
    x, y, w = x[w > 0], y[w > 0], w[w > 0].astype(float)
    stats = [np.bincount(y, w, 2)]
    made: dict[int, tuple] = {}  # id: gain, left child, feature, bins to the left
    ids = np.array([0]) if depth and _gini(stats[0]) >= _EPSILON else np.array([], int)
    at = np.zeros(len(w), np.int32)
    for level in range(depth):
        if not len(ids) or not len(w):
            break
        many = len(ids)
        feats = np.argsort(rng.random((many, size)), axis=1)[:, :drawn]
        hist = np.zeros(many * drawn * width * 2)
        for k in range(0, len(w), _CHUNK):
            part = slice(k, k + _CHUNK)
            node, flat = at[part].astype(np.int64), x[part].reshape(-1)
            row = np.arange(len(node)) * size
            base = node * (drawn * width * 2) + y[part]
            for j in range(drawn):
                b = flat[row + feats[:, j][node]].astype(np.int64)
                hist += np.bincount(base + (j * width + b) * 2, w[part], len(hist))
        h = hist.reshape(many, drawn, width, 2)
        # Categories stand in the order of their rows of class 1, those without rows last.
        places = np.broadcast_to(np.arange(width, dtype=float), h.shape[:3])
        place = np.where(ordered[feats][..., None], places, np.where(h.sum(-1) > 0, h[..., 1], np.inf))
        order = np.argsort(place, axis=2, kind="stable")
        left = np.cumsum(np.take_along_axis(h, order[..., None], 2), axis=2)
        whole = left[:, :, -1:, :]
        right = whole - left
        total, lw, rw = whole.sum(-1), left.sum(-1), right.sum(-1)
        gain = _gini(whole) - lw / total * _gini(left) - rw / total * _gini(right)
        gain[(lw <= 0) | (rw <= 0) | (np.arange(width) >= (sizes[feats] - 1)[..., None])] = -np.inf
        best = gain.reshape(many, -1).argmax(1)
        j, s = best // width, best % width
        each = np.arange(many)
        gained, feature = gain[each, j, s], feats[each, j]
        goes_left = np.argsort(order[each, j], axis=1) <= s[:, None]
        follow, ahead = np.full((many, 2), -1, np.int32), []
        for k in np.flatnonzero(gained > 0):
            first = len(stats)
            made[int(ids[k])] = (float(gained[k]), first, int(feature[k]), goes_left[k])
            stats += [left[k, j[k], s[k]], right[k, j[k], s[k]]]
            for side in (0, 1):
                if level + 1 < depth and _gini(stats[first + side]) >= _EPSILON:
                    follow[k, side] = len(ahead)
                    ahead.append(first + side)
        for k in range(0, len(w), _CHUNK):
            part = slice(k, k + _CHUNK)
            node = at[part]
            b = x[part].reshape(-1)[np.arange(len(node)) * size + feature[node]]
            at[part] = follow[node, np.where(goes_left[node, b], 0, 1)]
        stays = at >= 0
        if not stays.all():
            x, y, w, at = x[stays], y[stays], w[stays], at[stays]
        ids = np.array(ahead, int)
    return _as_stored(stats, made, kinds, splits)


def _as_stored(stats, made, kinds, splits) -> list[dict]:
    guess = [int(np.argmax(c)) for c in stats]
    for i in sorted(made, reverse=True):  # two leaves that say the same are one
        child = made[i][1]
        if child not in made and child + 1 not in made and guess[child] == guess[child + 1]:
            del made[i]
    kept, number = [0], {0: 0}
    for i in kept:
        if i in made:
            for child in (made[i][1], made[i][1] + 1):
                number[child] = len(kept)
                kept.append(child)
    out = []
    for i in kept:
        gain, child, feature, left = made.get(i, (-1.0, -1, -1, None))
        values: list[float] = []
        if feature >= 0:
            goes = np.flatnonzero(left)
            values = [float(c) for c in goes if c < kinds[feature]] if kinds[feature] else [splits[feature][goes[-1]]]
        out.append({
            "id": number[i], "prediction": float(guess[i]), "impurity": float(_gini(stats[i])),
            "impurityStats": [float(c) for c in stats[i]], "rawCount": int(stats[i].sum()), "gain": gain,
            "leftChild": number[child] if feature >= 0 else -1, "rightChild": number[child + 1] if feature >= 0 else -1,
            "split": {
                "featureIndex": feature, "leftCategoriesOrThreshold": values,
                "numCategories": (kinds[feature] or -1) if feature >= 0 else -1,
            },
        })
    return out


def _written(forest, trees: DataFrame, spark: SparkSession, size: int) -> RandomForestClassificationModel:
    """A model of Spark ML with these trees: a forest of two rows is stored and gets other nodes."""
    two = [(0.0, Vectors.dense([0.0] * size)), (1.0, Vectors.dense([1.0] * size))]
    frame = spark.createDataFrame(two, [forest.getLabelCol(), forest.getFeaturesCol()])
    shell, path = scratch_path(spark, "shell"), scratch_path(spark, "forest")
    forest.fit(frame.coalesce(1)).write().save(shell)
    spark.read.text(f"{shell}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.read.parquet(f"{shell}/treesMetadata").coalesce(1).write.parquet(f"{path}/treesMetadata")
    trees.write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
