"""Model scores from counted predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretide.functions.columns import finite
from caretide.operators.feeds import union_feeds
from caretide.operators.ranks import running_totals
from caretide.operators.schema import col
from caretide.session import materialize



def _label(df: DataFrame, name: str) -> Column:
    """A class label as text; 1, 1.0 and true are the same label."""
    c = col(name)
    kind = next(f.dataType for f in df.schema.fields if f.name == name)
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        whole = c.cast("bigint")
        return F.when(c == whole, whole.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def _counts(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """``(truth, prediction, n)`` as text labels; all later work is on this table."""
    return (
        df.filter(col(truth).isNotNull() & col(prediction).isNotNull())
        .groupBy(_label(df, truth).alias("truth"), _label(df, prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """``(truth, prediction, n)`` for all label pairs, absent ones 0."""
    counts = _counts(df, truth, prediction)
    labels = counts.select(F.explode(F.array("truth", "prediction")).alias("truth")).distinct()
    grid = labels.crossJoin(labels.select(F.col("truth").alias("prediction")))  # the matrix itself
    return grid.join(counts, ["truth", "prediction"], "left").select(
        "truth", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def _per_class(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """``(label, precision, recall, f1, support, tp)``; 0 where a class has no rows."""
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.inline(
        F.array(
            F.struct(
                F.col("truth").alias("label"),
                hit.alias("tp"),
                F.col("n").alias("support"),
                F.lit(0).cast("bigint").alias("predicted"),
            ),
            F.struct(
                F.col("prediction").alias("label"),
                F.lit(0).cast("bigint").alias("tp"),
                F.lit(0).cast("bigint").alias("support"),
                F.col("n").alias("predicted"),
            ),
        )
    )
    sums = (
        _counts(df, truth, prediction)
        .select(sides)
        .groupBy("label")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("pp"))
    )
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("support") + F.col("pp")), F.lit(0.0))
    return sums.select(
        "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp"
    )


def classification_metrics(
    df: DataFrame, truth: str, prediction: str, score: str | None = None, positive=1
) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1.

    With ``score`` the area under the ROC curve is added.
    """
    s = F.col("support").cast("double")
    weighted = lambda c: F.sum(s * F.col(c)) / F.sum(s)
    out = _per_class(df, truth, prediction).agg(
        (F.sum("tp").cast("double") / F.sum(s)).alias("accuracy"),
        *[weighted(c).alias(c) for c in ("precision", "recall", "f1")],
    )
    if score is not None:
        out = out.withColumn("roc_auc", roc_auc(df, truth, score, positive).scalar())
    return out


def classification_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class and for the averages.

    The accuracy row repeats the accuracy in every column, ``support`` included.
    """
    classes = materialize(_per_class(df, truth, prediction), "classes")
    s = F.col("support").cast("double")
    names = ("precision", "recall", "f1")
    accuracy = F.sum("tp").cast("double") / F.sum(s)
    rows = classes.select("label", *names, s.alias("support"))
    averages = [
        classes.agg(*[accuracy.alias(c) for c in (*names, "support")]).select(
            F.lit("accuracy").alias("label"), "*"
        ),
        classes.agg(*[F.avg(c).alias(c) for c in names], F.sum(s).alias("support")).select(
            F.lit("macro avg").alias("label"), "*"
        ),
        classes.agg(
            *[(F.sum(s * F.col(c)) / F.sum(s)).alias(c) for c in names], F.sum(s).alias("support")
        ).select(F.lit("weighted avg").alias("label"), "*"),
    ]
    return union_feeds([rows, *averages])


def roc_points(df: DataFrame, truth: str, score: str, positive=1) -> DataFrame:
    """One point per distinct score, from high to low: counts and rates at or above it.

    Scores are counted first; the running counts come from range-partitioned
    totals, so no task sees the whole curve.
    """
    is_pos = col(truth) == F.lit(positive)
    counts = (
        df.select(finite(col(score)).alias("threshold"), is_pos.alias("pos"))
        .filter("threshold is not null and pos is not null")
        .groupBy("threshold")
        .agg(F.count_if("pos").alias("p"), F.count_if(~F.col("pos")).alias("q"))
    )
    run = running_totals(counts, [F.col("threshold").desc()], ["p", "q"])
    tp, fp = F.col("p_before") + F.col("p"), F.col("q_before") + F.col("q")
    total = run.agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    positives, negatives = total.select("p").scalar(), total.select("q").scalar()
    return run.select(
        "threshold",
        "p",
        "q",
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(tp.cast("double"), positives).alias("tpr"),
        F.try_divide(fp.cast("double"), negatives).alias("fpr"),
    )


def roc_curve(df: DataFrame, truth: str, score: str, positive=1) -> DataFrame:
    """``(threshold, fpr, tpr)``; equal scores share one point."""
    return roc_points(df, truth, score, positive).select("threshold", "fpr", "tpr")


def roc_auc(df: DataFrame, truth: str, score: str, positive=1) -> DataFrame:
    """Area under the ROC curve by trapezoids; null without both classes."""
    points = roc_points(df, truth, score, positive)
    strips = F.col("q").cast("double") * (F.col("tp") - F.col("p") / F.lit(2.0))
    return points.agg(
        F.try_divide(F.sum(strips), F.sum("p").cast("double") * F.sum("q")).alias("roc_auc")
    )


def compare_models(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model from one-row metric frames."""
    return union_feeds([m.select(F.lit(name).alias("model"), "*") for name, m in results.items()])


def forecast_metrics(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """One row: MAE, RMSE, MAPE in percent, accuracy = 100 - MAPE, MSE, R2.

    MAPE is undefined where an actual value is 0: it is null then and
    ``zero_actuals`` tells how many there are.
    """
    y, p = finite(col(truth)), finite(col(prediction))
    gap = y - p
    known = df.filter(y.isNotNull() & p.isNotNull())
    zeros = F.count_if(y == 0)
    mse = F.avg(gap * gap)
    mape = F.when(zeros == 0, F.avg(F.abs(F.try_divide(gap, y))) * 100)
    return known.agg(
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(mse).alias("rmse"),
        mape.alias("mape"),
        (100 - mape).alias("accuracy"),
        mse.alias("mse"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        zeros.alias("zero_actuals"),
    )


def with_previous(daily: DataFrame, column: str, into: str, order_by: str = "ds") -> DataFrame:
    """A naive forecast: yesterday's value. For daily tables, whose rows are days."""
    return daily.withColumn(into, F.lag(col(column)).over(Window.orderBy(order_by)))
