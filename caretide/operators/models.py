"""Classifiers, splits and searches on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretide.operators.forest import fit_forest
from caretide.operators.schema import col
from caretide.session import broadcast_if_small, materialize

SEED = 42
_SLOTS = 1 << 20
#: Rows that one task may be left with; more are dealt out before training.
_TASK_ROWS = 500_000
#: Rows from which a forest of two classes is grown on binned rows, and what may be set for it.
_FOREST_ROWS = 250_000
_FOREST_PARAMS = {"numTrees", "maxDepth", "seed"}


def make_classifier(kind: str, rows: int | None = None, label: str = "label", **params):
    """An estimator by name: boosted_trees, random_forest, logistic, gradient_boost.

    ``xgboost`` is accepted for boosted_trees. Any Spark ML parameter
    can be given over the defaults, e.g. ``maxIter`` or ``weightCol``. The
    logistic penalty is ``1 / (C * rows)`` on unscaled features, with ``C=1``.
    """
    common = {"labelCol": label, "featuresCol": "features"}
    if kind in ("boosted_trees", "xgboost"):
        return GBTClassifier(
            **{"maxIter": 150, "maxDepth": 6, "stepSize": 0.1, "seed": SEED, **common, **params}
        )
    if kind == "random_forest":
        return RandomForestClassifier(
            **{"numTrees": 200, "maxDepth": 10, "seed": SEED, **common, **params}
        )
    if kind == "gradient_boost":
        return GBTClassifier(
            **{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": SEED, **common, **params}
        )
    if kind == "logistic":
        strength = params.pop("C", 1.0)
        if rows and "regParam" not in params:
            params["regParam"] = 1.0 / (strength * rows)
        return LogisticRegression(**{"maxIter": 1000, "standardization": False, **common, **params})
    raise ValueError(f"unknown model type: {kind}")


def _pipeline(kind, features, label, categoricals, rows, params, classes: int = 2) -> Pipeline:
    stages = []
    inputs = list(features)
    if categoricals:
        stages.append(encode_categoricals(categoricals))
        inputs += [f"{c}_index" for c in categoricals]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    classifier = make_classifier(kind, rows, label, **params)
    if classes > 2 and isinstance(classifier, GBTClassifier):
        # Boosting is binary in Spark ML: one model per class.
        weight = {"weightCol": params["weightCol"]} if "weightCol" in params else {}
        classifier = OneVsRest(classifier=classifier, labelCol=label, featuresCol="features", **weight)
    stages.append(classifier)
    return Pipeline(stages=stages)


def encode_categoricals(columns: Sequence[str]) -> StringIndexer:
    """Labels to numbers in alphabetical order; an unseen label gets its own number."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def with_class_weights(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Add balanced weights ``rows / (classes * rows of the class)`` for ``weightCol``."""
    known = df.filter(col(label).isNotNull())
    sizes = materialize(known.groupBy(col(label).alias("__l")).agg(F.count(F.lit(1)).alias("__n")), "classes")
    rows, classes = sizes.agg(F.sum("__n"), F.count(F.lit(1))).first()
    if not classes:
        return df.withColumn(into, F.lit(None).cast("double"))
    weight = F.lit(rows / classes) / F.col("__n")
    side = broadcast_if_small(sizes.select("__l", weight.alias("__w")))
    joined = df.join(side, col(label) == F.col("__l"), "left")
    return joined.withColumn(into, F.col("__w")).drop("__l", "__w")


def _dealt_out(df: DataFrame, rows: int) -> DataFrame:
    """A large table in equal parts, the same number for every core.

    A file is read in as many splits as its bytes make, but only those that begin a row
    group get rows, so training, which passes over its table again and again, could be a
    few tasks' work. Small tables are left as they are.
    """
    if rows <= _TASK_ROWS // 2:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * math.ceil(rows / (cores * _TASK_ROWS)))


def train_classifier(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = "boosted_trees",
    categoricals: Sequence[str] = (),
    **params,
) -> PipelineModel:
    """Fit a classifier on labels 0, 1, 2, ...; boosted kinds go one against the rest beyond two.

    A large table's forest of two classes is grown by :mod:`caretide.operators.forest`.
    """
    rows, top = df.agg(F.count(F.lit(1)), F.max(col(label))).first()
    classes = int(top or 0) + 1
    pipeline = _pipeline(kind, features, label, categoricals, rows if kind == "logistic" else None, params, classes)
    if kind == "random_forest" and classes == 2 and rows > _FOREST_ROWS and params.keys() <= _FOREST_PARAMS:
        *before, forest = pipeline.getStages()
        ready = Pipeline(stages=before).fit(df)
        grown = fit_forest(ready.transform(df), ready.stages[-1].getInputCols(), forest)
        if grown is not None:
            return PipelineModel([*ready.stages, grown])
    return pipeline.fit(_dealt_out(df, rows))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the ``probabilities`` of all classes by class number, ``prediction``, and the
    class-1 ``probability``.

    One-against-the-rest models give each class's logistic score, scaled to a sum of 1.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        shares = vector_to_array("probability")
    else:
        # A boosted margin m stands for the probability 1 / (1 + exp(-2m)).
        odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
        shares = F.transform(odds, lambda x: x / total)
    return out.select(
        *[col(c) for c in df.columns],
        shares.alias("probabilities"),
        "prediction",
        F.get(shares, F.lit(1)).alias("probability"),
    )


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame | None:
    """``(feature, importance)`` in descending order; None for a linear model."""
    last = model.stages[-1]
    parts = getattr(last, "models", [last])  # one against the rest: the mean over classes
    if not hasattr(parts[0], "featureImportances"):
        return None
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    weights = sum(m.featureImportances.toArray() for m in parts) / len(parts)
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _slot(keys: Sequence[str], seed: int, stratify: str | None, slots: int):
    """A number below ``slots`` from the first 8 hex digits of the MD5 of the seed, the class and
    the key, joined by ``|`` (null: empty), which any SQL engine can repeat."""
    named = [*([stratify] if stratify else []), *keys]
    whole = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(col(c).cast("string"), F.lit("")) for c in named])
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 8), 16, 10).cast("bigint") % slots


def split(
    df: DataFrame,
    keys: Sequence[str],
    test_size: float = 0.2,
    stratify: str | None = None,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row's key.

    Unlike ``randomSplit`` a row keeps its side however the table is partitioned.
    With ``stratify`` every class is hashed for itself, so its share holds too.
    """
    is_test = _slot(keys, seed, stratify, _SLOTS) < int(test_size * _SLOTS)
    return df.filter(~is_test), df.filter(is_test)


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    kind: str = "logistic",
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    metric: str = "areaUnderROC",
    parallelism: int = 4,
    stratify: bool = True,
    **params,
) -> CrossValidatorModel:
    """Cross-validation over hash folds, and a grid search if ``grid`` is given."""
    rows = df.count() if kind == "logistic" else None
    pipeline = _pipeline(kind, features, label, (), rows, params)
    estimator = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in (grid or {}).items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    fold = _slot(keys, SEED, label if stratify else None, folds).cast("int")
    # numBins=0: every distinct score is a point of the curve.
    judge = BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0)
    return CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=builder.build(),
        evaluator=judge,
        numFolds=folds,
        parallelism=parallelism,
        foldCol="__fold",
        seed=SEED,
    ).fit(df.withColumn("__fold", fold))


def search_table(fitted: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """``(params, mean_metric, std_metric)`` per tried setting."""
    rows = []
    spread = fitted.stdMetrics or [None] * len(fitted.avgMetrics)
    for params, mean, std in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, spread, strict=True):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda e: e[0].name))
        rows.append((text, float(mean), None if std is None else float(std)))
    return df.sparkSession.createDataFrame(rows, "params string, mean_metric double, std_metric double")
