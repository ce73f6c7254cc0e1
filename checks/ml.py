"""Classifier scores, training, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide.operators import evaluate as ev
from caretide.operators import forecast as fc
from caretide.operators import models as md
from caretide.session import materialize, scratch_path
from checks.registry import duck_date, query, rounded, table, text_date, view, with_views
from checks.scalars import DUCK_DERIVED, derived

_PER_CLASS = """k AS (SELECT unnest([0, 1]) AS label),
  c AS (SELECT label, count(*) FILTER (quality = label AND toxic = label)::DOUBLE AS tp,
    count(*) FILTER (quality = label)::DOUBLE AS support, count(*) FILTER (toxic = label)::DOUBLE AS pp
    FROM k, labels GROUP BY label),
  m AS (SELECT label, tp, support, coalesce(tp / nullif(pp, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(support + pp, 0), 0) AS f1 FROM c)"""


@query(
    "classification_metrics",
    f"""WITH {_PER_CLASS} SELECT round(sum(tp) / sum(support), 6) AS accuracy,
    round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall,
    round(sum(f1 * support) / sum(support), 6) AS f1 FROM m""",
)
def classification_metrics(spark, sf):
    out = ev.classification_metrics(table(spark, sf, "labels"), "quality", "toxic")
    return rounded(out, "accuracy", "precision", "recall", "f1")


@query(
    "confusion_matrix",
    """SELECT CAST(t AS VARCHAR) AS truth, CAST(p AS VARCHAR) AS prediction,
    count(*) FILTER (quality = t AND toxic = p) AS n
    FROM (SELECT unnest([0, 1]) AS t), (SELECT unnest([0, 1]) AS p), labels GROUP BY t, p""",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic")


@query(
    "classification_report",
    f"""WITH {_PER_CLASS}, acc AS (SELECT sum(tp) / sum(support) AS a FROM m),
    u AS (SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM m
      UNION ALL SELECT 'accuracy', a, a, a, a FROM acc
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM m)
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
      round(support, 6) AS support FROM u""",
)
def classification_report(spark, sf):
    out = ev.classification_report(table(spark, sf, "labels"), "quality", "toxic")
    return rounded(out, "precision", "recall", "f1", "support")


def _scored(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").join(docs, "doc_id")


_ROC = """j AS (SELECT n_chars::DOUBLE AS threshold, quality FROM labels JOIN documents USING (doc_id)),
  c AS (SELECT threshold, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS q FROM j GROUP BY 1),
  r AS (SELECT threshold, p, q, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER () AS np, sum(q) OVER () AS nq
    FROM c WINDOW w AS (ORDER BY threshold DESC))"""


@query(
    "roc_curve",
    f"WITH {_ROC} SELECT threshold, round(fp::DOUBLE / nq, 6) AS fpr, round(tp::DOUBLE / np, 6) AS tpr FROM r",
)
def roc_curve(spark, sf):
    return rounded(ev.roc_curve(_scored(spark, sf), "quality", "n_chars"), "fpr", "tpr")


@query(
    "roc_auc",
    f"WITH {_ROC} SELECT round(sum(q * (tp - p / 2.0::DOUBLE)) / any_value(np * nq), 6) AS roc_auc FROM r",
)
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(_scored(spark, sf), "quality", "n_chars"), "roc_auc")


@query(
    "compare_models",
    """WITH s AS (SELECT 'toxic' AS model, quality, toxic AS pred FROM labels
      UNION ALL SELECT 'long', quality, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END FROM labels JOIN documents USING (doc_id))
    SELECT model, round(count(*) FILTER (quality = pred)::DOUBLE / count(*), 6) AS accuracy FROM s GROUP BY 1""",
)
def compare_models(spark, sf):
    scored = _scored(spark, sf).withColumn("long", (F.col("n_chars") > 2000).cast("int"))
    results = {m: ev.classification_metrics(scored, "quality", m) for m in ("toxic", "long")}
    return rounded(ev.compare_models(results), "accuracy").select("model", "accuracy")


@query(
    "forecast_metrics",
    with_views("v_daily")
    + """, p AS (SELECT y, lag(y) OVER (ORDER BY ds) AS f FROM v_daily),
    g AS (SELECT y, f, y - f AS e FROM p WHERE f IS NOT NULL)
    SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e / y)) * 100, 6) AS mape,
      round(100 - avg(abs(e / y)) * 100, 6) AS accuracy, round(avg(e * e), 6) AS mse,
      round(1 - avg(e * e) / var_pop(y), 6) AS r2, count(*) FILTER (y = 0) AS zero_actuals FROM g""",
)
def forecast_metrics(spark, sf):
    daily = ev.with_previous(view(spark, sf, "v_daily"), "y", "naive")
    out = ev.forecast_metrics(daily, "y", "naive")
    return rounded(out, "mae", "rmse", "mape", "accuracy", "mse", "r2")


@query(
    "sort_series",
    with_views("v_daily") + f" SELECT {duck_date('ds')} AS ds, y FROM v_daily ORDER BY v_daily.ds",
)
def sort_series(spark, sf):
    out = fc.prepare_series(view(spark, sf, "v_daily"), "y", "ds")
    return out.withColumn("ds", text_date("ds"))


# --- training (fixed seeds; results are not SQL) ----------------------------

FEATURES = ("arrival_hour", "day_of_week", "is_weekend", "AGE", "LOS", "has_insurance")


def training(spark, sf):
    """Visits with complete features; long waits are what is predicted.

    Stored once, because training reads its table many times.
    """
    visits = derived(spark, sf).na.drop(subset=[*FEATURES, "WAITTIME", "RFV1"])
    label = (F.col("WAITTIME") > 20).cast("int").alias("label")
    return materialize(visits.select("visit_id", "RFV1", *FEATURES, label), "training")


def _train(kind: str, **settings):
    def run(spark, sf):
        params = dict(settings)
        data = training(spark, sf)
        train, test = md.split(data, ["visit_id"], stratify="label")
        if params.pop("balanced", False):
            train, params["weightCol"] = md.with_class_weights(train, "label"), "weight"
        model = md.train_classifier(train, FEATURES, "label", kind, categoricals=["RFV1"], **params)
        scored = md.predict(model, test).select("label", "prediction", "probability")
        out = ev.classification_metrics(
            materialize(scored, "scored"), "label", "prediction", "probability"
        )
        return rounded(out, "accuracy", "precision", "recall", "f1", "roc_auc", digits=3)

    return run


query("train_boosted_trees")(_train("boosted_trees"))
query("train_random_forest")(_train("random_forest"))
query("train_logistic")(_train("logistic"))
query("train_gradient_boost")(_train("gradient_boost"))


@query("predict")
def predict(spark, sf):
    """A model that is trained, saved, loaded and applied."""
    train, test = md.split(training(spark, sf), ["visit_id"])
    path = scratch_path(spark, "model")
    md.save_model(md.train_classifier(train, FEATURES, "label", "logistic"), path)
    out = md.predict(md.load_model(path), test)
    return rounded(out.select("visit_id", "label", "prediction", "probability"), "probability", digits=3)


@query("feature_importance")
def feature_importance(spark, sf):
    data = training(spark, sf)
    model = md.train_classifier(data, FEATURES, "label", "random_forest")
    return md.feature_importance(model, data)


@query(
    "class_weights",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT doc_id, round((SELECT sum(n)::DOUBLE / count(*) FROM c) / n, 6) AS weight FROM labels JOIN c USING (quality)""",
)
def class_weights(spark, sf):
    out = md.with_class_weights(table(spark, sf, "labels"), "quality")
    return rounded(out, "weight").select("doc_id", "weight")


query("train_balanced")(_train("logistic", balanced=True))


def _duck_slot(slots: str) -> str:
    text = "concat('42|', CAST(label AS VARCHAR), '|', CAST(visit_id AS VARCHAR))"
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % {slots}"


_DUCK_TRAINING = (
    with_views("v_visits")
    + f""", {DUCK_DERIVED}, training AS (SELECT visit_id, CASE WHEN WAITTIME > 20 THEN 1 ELSE 0 END AS label FROM e
      WHERE WAITTIME IS NOT NULL AND RFV1 IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)})"""
)


@query(
    "split",
    _DUCK_TRAINING + f" SELECT visit_id, label, CASE WHEN {_duck_slot('1048576')} < 209715 THEN 1 ELSE 0 END AS is_test FROM training",
)
def split(spark, sf):
    """Which rows are test rows, within each class."""
    train, test = md.split(training(spark, sf), ["visit_id"], 0.2, "label")
    both = train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))
    return both.select("visit_id", "label", "is_test")


@query(
    "encode_categoricals",
    with_views("v_visits")
    + """, k AS (SELECT RFV1, row_number() OVER (ORDER BY RFV1) - 1 AS i FROM (SELECT DISTINCT RFV1 FROM v_visits
      WHERE RFV1 IS NOT NULL))
    SELECT visit_id, RFV1, coalesce(i, (SELECT count(*) FROM k))::DOUBLE AS RFV1_index FROM v_visits LEFT JOIN k USING (RFV1)""",
)
def encode_categoricals(spark, sf):
    visits = view(spark, sf, "v_visits").select("visit_id", "RFV1")
    return md.encode_categoricals(["RFV1"]).fit(visits).transform(visits)


@query("cross_validate")
def cross_validate(spark, sf):
    data = training(spark, sf)
    fitted = md.cross_validate(data, FEATURES, "label", ["visit_id"], "logistic")
    return rounded(md.search_table(fitted, data), "mean_metric", "std_metric", digits=3)


@query("grid_search")
def grid_search(spark, sf):
    data = training(spark, sf)
    grid = {"regParam": (0.0, 0.1), "elasticNetParam": (0.0, 1.0)}
    fitted = md.cross_validate(data, FEATURES, "label", ["visit_id"], "logistic", grid)
    return rounded(md.search_table(fitted, data), "mean_metric", "std_metric", digits=3)


@query("forecast")
def forecast(spark, sf):
    daily = view(spark, sf, "v_orders_daily")
    return fc.fit_forecast(daily).forecast(daily, 30).withColumn("ds", text_date("ds"))


@query("forecast_many")
def forecast_many(spark, sf):
    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("ds"))
        .agg(F.avg("value").alias("y"))
    )
    return fc.forecast_many(daily, 14, 0.95).withColumn("ds", text_date("ds"))


@query("boosted_forecast")
def boosted_forecast(spark, sf):
    _, out = fc.boosted_forecast(view(spark, sf, "v_orders_daily"), "2000-12-31")
    return rounded(out, "yhat", digits=2).withColumn("ds", text_date("ds"))
