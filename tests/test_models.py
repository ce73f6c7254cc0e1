"""Scores against brute force; training, searches and forecasts on fixed seeds."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretide.operators import evaluate as ev
from caretide.operators import forecast as fc
from caretide.operators import models as md
from caretide.operators.forest import fit_forest
from caretide.session import scratch_path


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [(None, "a")]
    return spark.createDataFrame(rows, "y string, p string")


def test_confusion_matrix_keeps_zero_cells(predictions):
    got = {(r["truth"], r["prediction"]): r["n"] for r in ev.confusion_matrix(predictions, "y", "p").collect()}
    assert len(got) == 9 and got["a", "b"] == 2 and got["c", "c"] == 0 and sum(got.values()) == 11


def test_metrics_of_a_class_never_predicted(predictions):
    row = ev.classification_metrics(predictions, "y", "p").first()
    assert row["accuracy"] == pytest.approx(8 / 11) and row["recall"] == pytest.approx(8 / 11)
    assert row["precision"] == pytest.approx((7 * 5 / 6 + 3 * 3 / 5) / 11)
    assert row["f1"] == pytest.approx((7 * (10 / 13) + 3 * (6 / 8)) / 11)


def test_number_labels_match_across_types(spark):
    df = spark.createDataFrame([(1, 1.0, True), (0, 0.0, True), (1, 0.0, True)], "y int, p double, b boolean")
    assert ev.classification_metrics(df, "y", "p").first()["accuracy"] == pytest.approx(2 / 3)
    assert ev.classification_metrics(df, "y", "b").first()["accuracy"] == pytest.approx(2 / 3)


def test_report_rows(predictions):
    got = {r["label"]: r for r in ev.classification_report(predictions, "y", "p").collect()}
    assert set(got) == {"a", "b", "c", "accuracy", "macro avg", "weighted avg"}
    assert got["c"]["precision"] == 0 and got["c"]["support"] == 1
    assert got["accuracy"]["support"] == got["accuracy"]["f1"] == pytest.approx(8 / 11)
    assert got["macro avg"]["precision"] == pytest.approx((5 / 6 + 3 / 5) / 3)


def test_roc_with_ties(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.normal(size=200) + y, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)] + [(1, None)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert ev.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    points = ev.roc_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert len(points) == len(set(s)) and (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert ev.roc_auc(df.filter("y = 1"), "y", "s").first()[0] is None
    row = ev.classification_metrics(df.withColumn("p", (F.col("s") > 0).cast("int")), "y", "p", "s").first()
    assert row["roc_auc"] == pytest.approx(want)


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 25.0), (None, 1.0), (40.0, None)], "y double, p double")
    row = ev.forecast_metrics(df, "y", "p").first()
    assert row["mae"] == 3.5 and row["rmse"] == pytest.approx(math.sqrt(14.5))
    assert row["mape"] == pytest.approx(22.5) and row["accuracy"] == pytest.approx(77.5)
    assert row["r2"] == pytest.approx(1 - 14.5 / 25)
    zero = ev.forecast_metrics(spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double"), "y", "p").first()
    assert zero["mape"] is None and zero["accuracy"] is None and zero["zero_actuals"] == 1


def test_compare_models(predictions):
    out = ev.compare_models({m: ev.classification_metrics(predictions, "y", "p") for m in ("m1", "m2")})
    assert [r["model"] for r in out.orderBy("model").collect()] == ["m1", "m2"]


@pytest.fixture(scope="module")
def visits(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        a, b, g = float(rng.normal()), float(rng.normal()), "xyz"[i % 3]
        rows.append((i, a, b, g, int(a + 0.5 * b + (g == "x") + rng.normal() * 0.3 > 0.3)))
    return spark.createDataFrame(rows, "id int, a double, b double, g string, label int").persist()


@pytest.mark.parametrize(
    ("kind", "params"),
    [
        ("boosted_trees", {"maxIter": 5, "maxDepth": 3}),
        ("xgboost", {"maxIter": 3, "maxDepth": 2}),
        ("random_forest", {"numTrees": 10, "maxDepth": 5}),
        ("gradient_boost", {"maxIter": 5}),
        ("logistic", {}),
    ],
)
def test_classifiers_learn(visits, kind, params):
    train, test = md.split(visits, ["id"], 0.25, "label")
    model = md.train_classifier(train, ["a", "b"], "label", kind, ["g"], **params)
    row = ev.classification_metrics(md.predict(model, test), "label", "prediction", "probability").first()
    assert row["accuracy"] > 0.75 and row["roc_auc"] > 0.85
    importance = md.feature_importance(model, visits)
    if kind == "logistic":
        assert importance is None
    else:
        rows = importance.collect()
        assert rows[0]["feature"] == "a" and {r["feature"] for r in rows} == {"a", "b", "g_index"}


@pytest.mark.parametrize("kind", ["gradient_boost", "random_forest", "logistic"])
def test_three_classes(spark, visits, kind):
    data = visits.withColumn("label", F.when(F.col("a") > 0.5, 2).when(F.col("a") < -0.5, 1).otherwise(0))
    model = md.train_classifier(data, ["a", "b"], "label", kind, **({} if kind == "logistic" else {"maxDepth": 3} | ({"maxIter": 3} if kind == "gradient_boost" else {"numTrees": 5})))
    out = md.predict(model, data).collect()
    assert all(len(r["probabilities"]) == 3 and sum(r["probabilities"]) == pytest.approx(1) for r in out)
    assert all(r["probability"] == r["probabilities"][1] for r in out)
    assert sum(r["label"] == r["prediction"] for r in out) > 0.9 * len(out)
    found = md.feature_importance(model, data)
    assert found is None if kind == "logistic" else found.first()["feature"] == "a"


def test_logistic_penalty_matches_the_objective(visits):
    """Gradient of sum(loss) + |w|^2 / 2 is zero at the fit (C = 1)."""
    model = md.train_classifier(visits, ["a", "b"], "label", "logistic", tol=1e-10).stages[-1]
    data = np.array([(r["a"], r["b"], r["label"]) for r in visits.collect()])
    x, y = data[:, :2], data[:, 2]
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    np.testing.assert_allclose(x.T @ (p - y) + w, 0, atol=1e-3)


def test_class_weights_balance(visits, spark):
    sums = md.with_class_weights(visits, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert all(r["w"] == pytest.approx(300) for r in sums)
    empty = md.with_class_weights(visits.limit(0), "label")
    assert empty.count() == 0 and "weight" in empty.columns


def test_unknown_model_is_refused(visits):
    with pytest.raises(ValueError, match="unknown model"):
        md.train_classifier(visits, ["a"], "label", "svm")


def test_save_and_load(visits, spark):
    model = md.train_classifier(visits, ["a", "b"], "label", "logistic", ["g"])
    path = scratch_path(spark, "model")
    md.save_model(model, path)
    first, second = (md.predict(m, visits).orderBy("id").limit(5).collect() for m in (model, md.load_model(path)))
    assert first == second and list(first[0].asDict())[-2:] == ["prediction", "probability"]


def test_split_is_stable_and_stratified(visits):
    train, test = md.split(visits, ["id"], 0.2, "label")
    again = md.split(visits.repartition(7), ["id"], 0.2, "label")[1]
    ids = {r["id"] for r in test.collect()}
    assert ids == {r["id"] for r in again.collect()} and train.count() + len(ids) == 600
    shares = test.groupBy("label").count().collect()
    assert all(0.1 < r["count"] / visits.filter(F.col("label") == r["label"]).count() < 0.3 for r in shares)


def test_grid_search(visits):
    fitted = md.cross_validate(
        visits, ["a", "b"], "label", ["id"], "logistic", {"regParam": (0.0, 10.0)}, folds=3, maxIter=10
    )
    rows = {r["params"]: r["mean_metric"] for r in md.search_table(fitted, visits).collect()}
    assert set(rows) == {"regParam=0.0", "regParam=10.0"} and max(rows.values()) > 0.8


def test_unseen_category_gets_its_own_number(visits, spark):
    model = md.encode_categoricals(["g"]).fit(visits)
    got = model.transform(spark.createDataFrame([("z",), ("x",), ("new",), (None,)], "g string")).collect()
    assert [r["g_index"] for r in got] == [2.0, 0.0, 3.0, 3.0]


def _daily(spark, days=400):
    start = dt.date(2023, 1, 1)
    rows = [
        (start + dt.timedelta(days=i), 100 + 0.1 * i + 20 * math.sin(2 * math.pi * i / 7) + 5 * math.sin(2 * math.pi * i / 365.25))
        for i in range(days)
    ]
    return spark.createDataFrame(rows, "ds date, y double"), rows


def test_forecast_follows_trend_and_week(spark):
    daily, rows = _daily(spark)
    out = fc.fit_forecast(daily).forecast(daily, 14).orderBy("ds").collect()
    assert len(out) == 414 and out[-1]["ds"] == rows[-1][0] + dt.timedelta(days=14)
    i = 410
    truth = 100 + 0.1 * i + 20 * math.sin(2 * math.pi * i / 7) + 5 * math.sin(2 * math.pi * i / 365.25)
    assert out[i]["yhat"] == pytest.approx(truth, abs=12) and out[i]["yhat_lower"] < out[i]["yhat"] < out[i]["yhat_upper"]
    wide = fc.fit_forecast(daily).forecast(daily, 1, 0.95).orderBy("ds").first()
    narrow = fc.fit_forecast(daily).forecast(daily, 1, 0.80).orderBy("ds").first()
    ratio = (wide["yhat_upper"] - wide["yhat"]) / (narrow["yhat_upper"] - narrow["yhat"])
    assert ratio == pytest.approx(1.959964 / 1.281552, rel=1e-4)
    assert fc.fit_forecast(daily).forecast(daily, 0).count() == 400


def test_forecast_many_matches_single_history(spark):
    daily, _ = _daily(spark, 120)
    both = daily.withColumn("series", F.lit("a")).unionByName(
        daily.withColumn("series", F.lit("b")).withColumn("y", F.col("y") * 2)
    )
    got = fc.forecast_many(both, 7).collect()
    assert len(got) == 2 * 127
    a, b = ({r["ds"]: r["yhat"] for r in got if r["series"] == s} for s in "ab")
    assert all(b[d] == pytest.approx(2 * a[d], rel=1e-6) for d in a)
    single = fc.fit_forecast(daily).forecast(daily, 7).collect()
    assert all(a[r["ds"]] == pytest.approx(r["yhat"], rel=1e-3) for r in single)
    history = {r["ds"]: r["y"] for r in daily.collect()}
    assert np.mean([abs(a[d] - y) for d, y in history.items()]) < 5


def test_forecast_of_nothing(spark):
    with pytest.raises(ValueError, match="no values"):
        fc.fit_forecast(spark.createDataFrame([], "ds date, y double"))


def test_boosted_forecast_sees_only_the_past(spark):
    daily, rows = _daily(spark, 200)
    data, names = fc.boosted_features(daily)
    row = data.orderBy("ds").first()
    by_day = dict(rows)
    assert row["past"] == by_day[row["ds"] - dt.timedelta(days=1)] and "y" not in names
    _, out = fc.boosted_forecast(daily, str(rows[150][0]), maxIter=10, maxDepth=4)
    assert out.count() == 49
    assert ev.forecast_metrics(out, "y", "yhat").first()["mape"] < 15


def test_prepare_series(spark):
    df = spark.createDataFrame([("2024-01-02", 2), ("2024-01-01", 1)], "d string, v int")
    assert [(str(r["ds"]), r["y"]) for r in fc.prepare_series(df, "v", "d").collect()] == [("2024-01-01", 1.0), ("2024-01-02", 2.0)]


def test_large_tables_are_dealt_out_before_training(spark, monkeypatch):
    rows = [(float(i % 17), float(i % 5), int(i % 17 > 8)) for i in range(1000)]
    whole = spark.createDataFrame(rows, "a double, b double, label int").coalesce(1)
    seen = []
    fit = md.Pipeline.fit
    monkeypatch.setattr(md.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    monkeypatch.setattr(md, "_TASK_ROWS", 100)
    model = md.train_classifier(whole, ["a", "b"], "label", "random_forest", numTrees=3, maxDepth=3)
    cores = spark.sparkContext.defaultParallelism
    sizes = [len(part) for part in seen[0].rdd.glom().collect()]
    assert len(sizes) % cores == 0 and sum(sizes) == 1000 and max(sizes) <= 110
    assert sorted(tuple(r) for r in seen[0].collect()) == sorted(rows)
    assert md.predict(model, whole).filter("prediction = label").count() == 1000
    monkeypatch.setattr(md, "_TASK_ROWS", 2000)
    md.train_classifier(whole, ["a", "b"], "label", "random_forest", numTrees=3, maxDepth=3)
    assert seen[1].rdd.getNumPartitions() == 1  # small tables, and what is learnt from them, stay as they are


def _clinic(spark, n=6000):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        a, b, h, g = float(rng.normal()), int(rng.integers(0, 90)), int(rng.integers(0, 24)), "pqrs"[i % 4]
        rows.append((i, a, b, h, g, int(a + 0.02 * b + 0.8 * (g in "ps") + rng.normal() * 0.5 > 1.2)))
    return spark.createDataFrame(rows, "id int, a double, b int, h int, g string, label int").repartition(3).persist()


def test_forest_of_a_large_table_trains_on_binned_rows(spark, monkeypatch):
    data = _clinic(spark)
    args = (data, ["a", "b", "h"], "label", "random_forest", ["g"])
    params = {"numTrees": 40, "maxDepth": 6}
    plain = md.train_classifier(*args, **params)
    seen, fit = [], md.RandomForestClassifier._fit
    monkeypatch.setattr(md.RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    monkeypatch.setattr(md, "_FOREST_ROWS", 1000, raising=False)
    model = md.train_classifier(*args, **params)
    assert seen == [2]  # Spark's trainer gets no row of the table
    last = model.stages[-1]
    assert last.getNumTrees == 40 and last.numClasses == 2 and max(t.depth for t in last.trees) == 6
    # Every row is in the bags as often as its draws say: about once per tree.
    roots = [t._call_java("rootNode").impurityStats().rawCount() for t in last.trees]
    assert abs(np.mean(roots) - 6000) < 60 and 30 < np.std(roots) < 150
    ours, theirs = ({r["feature"]: r["importance"] for r in md.feature_importance(m, data).collect()} for m in (model, plain))
    assert all(ours[k] == pytest.approx(theirs[k], abs=0.05) for k in theirs)
    got = [ev.classification_metrics(md.predict(m, data), "label", "prediction", "probability").first() for m in (model, plain)]
    assert got[0]["accuracy"] == pytest.approx(got[1]["accuracy"], abs=0.02) and got[0]["roc_auc"] == pytest.approx(got[1]["roc_auc"], abs=0.01)
    path = scratch_path(spark, "model")
    md.save_model(model, path)
    again = md.predict(md.load_model(path), data).orderBy("id").limit(20).collect()
    assert again == md.predict(model, data).orderBy("id").limit(20).collect()
    # Missing values and other settings stay with Spark's trainer.
    with pytest.raises(Exception, match="(?i)null"):
        md.train_classifier(data.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), *args[1:], **params)
    md.train_classifier(*args, **params, minInstancesPerNode=5)
    assert seen[-1] == 6000


def test_a_tree_on_counted_rows_splits_best():
    from caretide.operators.forest import grow_tree

    rng = np.random.default_rng(3)
    x = np.array([(i, j) for i in range(8) for j in range(5) for _ in (0, 1)], np.uint8)
    y, n = np.tile([0, 1], 40).astype(np.int8), rng.integers(1, 300, 80)
    splits, kinds, bins = {0: [i + 0.5 for i in range(7)]}, {0: 0, 1: 5}, [8, 5]
    nodes = grow_tree(x, y, n, bins, kinds, splits, 5, [1, 2])
    w = np.random.default_rng([1, 2]).poisson(n)

    def gini(rows):
        c = np.bincount(y[rows], w[rows], 2)
        return 1 - ((c / c.sum()) ** 2).sum()

    def check(at, rows):
        node = nodes[at]
        assert node["rawCount"] == w[rows].sum() and node["impurityStats"] == list(np.bincount(y[rows], w[rows], 2))
        assert node["prediction"] == np.argmax(node["impurityStats"])
        if node["leftChild"] < 0:
            return 1
        ways = [(0, set(range(s + 1))) for s in range(7)]
        order = sorted((c for c in range(5) if w[rows & (x[:, 1] == c)].sum()), key=lambda c: w[rows & (x[:, 1] == c) & (y == 1)].sum())
        ways += [(1, set(order[: s + 1])) for s in range(len(order) - 1)]
        gains = []
        for f, left in ways:
            goes = rows & np.isin(x[:, f], list(left))
            other = rows & ~goes
            if w[goes].sum() and w[other].sum():
                share = w[goes].sum() / w[rows].sum()
                gains.append(gini(rows) - share * gini(goes) - (1 - share) * gini(other))
        assert node["gain"] == pytest.approx(max(gains))  # two features, both drawn
        split = node["split"]
        values = split["leftCategoriesOrThreshold"]
        goes = rows & (np.isin(x[:, 1], values) if split["numCategories"] == 5 else x[:, 0] <= values[0])
        return check(node["leftChild"], goes) + check(node["rightChild"], rows & ~goes)

    assert check(0, np.ones(80, bool)) > 6 and [v["id"] for v in nodes] == list(range(len(nodes)))


def test_importance_of_a_large_forest(spark, monkeypatch):
    data = _clinic(spark, 3000).withColumns({"still": F.lit(1), "late": F.col("h") > 12, "a": F.round("a", 1)})
    args = (data, ["a", "b", "h", "still", "late"], "label", "random_forest")
    plain = md.feature_importance(md.train_classifier(*args, numTrees=30, maxDepth=5), data)
    seen, fit = [], md.RandomForestClassifier._fit
    monkeypatch.setattr(md.RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    monkeypatch.setattr(md, "_FOREST_ROWS", 1000, raising=False)
    rows = md.feature_importance(md.train_classifier(*args, numTrees=30, maxDepth=5), data).collect()
    assert seen == [2] and [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    ours, theirs = ({r["feature"]: r["importance"] for r in x} for x in (rows, plain.collect()))
    assert sum(ours.values()) == pytest.approx(1) and ours["still"] == 0 and rows[0]["feature"] == "a"
    assert all(ours[k] == pytest.approx(theirs[k], abs=0.05) for k in theirs)
    # Too many different rows to send to every task: Spark's trainer takes them all.
    monkeypatch.setattr(md, "fit_forest", lambda df, inputs, forest: fit_forest(df, inputs, forest, 10))
    md.train_classifier(*args, numTrees=2, maxDepth=2)
    assert seen[-1] == 3000
