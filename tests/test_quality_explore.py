"""Reports, summaries and dashboards on hand-made rows."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caretide.operators import explore as ex
from caretide.operators import features as ft
from caretide.operators import quality as ql
from caretide.plans.enrich import all_features
from caretide.plans.report import quality_report


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, 1.0, "a", "01012024"),
        (2, math.nan, "b", "01312024"),
        (None, 3.0, "a", "bad"),
        (None, 4.0, None, None),
        (None, 100.0, "c", "01012024"),
    ]
    return spark.createDataFrame(rows, "n int, x double, s string, d string")


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_missing_report_counts_nan(mixed):
    got = _by(ql.missing_report(mixed), "column")
    assert (got["x"]["missing"], got["n"]["missing"], got["__total__"]["missing"]) == (1, 3, 6)
    assert got["n"]["high_missing"] and not got["x"]["high_missing"]


def test_missing_ratio_at_the_threshold_is_not_high(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert not _by(ql.missing_report(df), "column")["x"]["high_missing"]


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "n int, s string")
    assert tuple(ql.duplicate_report(df).first()) == (5, 2, 0.4)
    assert ql.duplicate_report(df, ["n"]).first()["duplicate_count"] == 3
    assert tuple(ql.duplicate_report(df.limit(0)).first()) == (0, 0, 0.0)


def test_numeric_report(mixed):
    got = {(r["column"], r["metric"]): r["value"] for r in ql.numeric_report(mixed, {"x": (0, 50)}).collect()}
    assert got["x", "median"] == 3.5 and got["x", "range_violations"] == 1
    assert got["x", "outlier_count"] == 1 and got["x", "outlier_ratio"] == pytest.approx(0.2)
    assert got["n", "std"] == pytest.approx(math.sqrt(0.5))


def test_numeric_report_of_empty_columns(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    got = {r["metric"]: r["value"] for r in ql.numeric_report(df).collect()}
    assert got["outlier_count"] == 0 and got["mean"] is None and got["lower_bound"] is None


def test_categorical_report(mixed):
    got = _by(ql.categorical_report(mixed, ["s"], min_categories=4), "column")["s"]
    assert (got["n_unique"], got["null_count"], got["warning"]) == (3, 1, "few values")
    top = ql.categorical_top(mixed, ["s"], 2).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in top] == [("a", 2), ("b", 1)]


def test_high_cardinality_warning(spark):
    df = spark.range(150).select(F.col("id").cast("string").alias("s"))
    assert ql.categorical_report(df).first()["warning"] == "high cardinality"


def test_date_report(mixed, spark):
    got = _by(ql.date_report(mixed, ["d", "absent"]), "column")
    assert (got["d"]["null_count"], got["d"]["range_days"]) == (2, 30)
    none = ql.date_report(spark.createDataFrame([("x",)], "d string"), ["d"]).first()
    assert (none["range_days"], none["min_date"]) == (0, None)
    assert ql.date_report(mixed, ["absent"]).count() == 0


def test_quality_report_has_all_checks(mixed):
    got = {r["check"] for r in quality_report(mixed, {"x": (0, 50)}, ["d"]).collect()}
    assert got == {"dataset", "missing", "duplicates", "types", "numeric", "categorical", "top_values", "dates"}
    rows = {(r["check"], r["column"], r["metric"]): r["value"] for r in quality_report(mixed, store=True).collect()}
    assert rows["dataset", "__table__", "n_rows"] == "5" and rows["top_values", "s", "1: a"] == "2"
    assert rows["missing", "x", "missing"] == "1" and rows["duplicates", "__table__", "duplicate_count"] == "0"


def test_summary_and_distribution_equal_pandas(spark):
    values = [float(v) for v in [3, 1, 4, 1, 5, 9, 2, 6]] + [math.nan, None]
    df = spark.createDataFrame([(v, 7.0, 1.0 if i == 0 else None) for i, v in enumerate(values)], "x double, flat double, one double")
    s = pd.Series(values, dtype=float)
    row = _by(ex.summary_stats(df), "column")["x"]
    for name, want in s.describe().items():
        assert row[{"25%": "p25", "50%": "p50", "75%": "p75"}.get(name, name)] == pytest.approx(want)
    assert (row["missing"], row["missing_pct"]) == (2, pytest.approx(20.0))
    got = {(r["column"], r["metric"]): r["value"] for r in ex.distribution_stats(df, ["x", "flat", "one"]).collect()}
    assert got["x", "skewness"] == pytest.approx(s.skew()) and got["x", "kurtosis"] == pytest.approx(s.kurt())
    assert got["flat", "skewness"] == 0 and got["flat", "kurtosis"] == 0
    assert got["one", "skewness"] is None and got["one", "std"] is None


@pytest.mark.parametrize("more", [0, 45])
def test_correlations_equal_pandas(spark, more):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(60, 3)), columns=["a", "b", "c"])
    pdf["d"] = pdf["a"] * 2 + 1e6
    pdf.loc[::7, "b"] = np.nan
    pdf["flat"] = 0.1  # no exact binary value: rounding must not make it vary
    for k in range(more):
        pdf[f"m{k}"] = rng.normal(size=60)
    want = pdf.corr()
    want.loc["flat"] = want["flat"] = np.nan
    for r in ex.correlations(spark.createDataFrame(pdf).repartition(3)).collect():
        value = want.loc[r["var1"], r["var2"]]
        if math.isnan(value):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(value, abs=1e-9)
    strong = ex.strong_correlations(spark.createDataFrame(pdf), 0.9).collect()
    assert [(r["var1"], r["var2"]) for r in strong] == [("a", "d")]


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "s string")
    assert [tuple(r) for r in ex.value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]
    assert ex.value_share(df, "s").first()["pct"] == pytest.approx(200 / 3)
    week = ex.day_of_week_counts(spark.createDataFrame([(0,), (0,), (6,), (None,)], "day_of_week int"))
    assert [r["n"] for r in week.collect()] == [2, 0, 0, 0, 0, 0, 1]


def test_top_terms_drops_none(spark):
    df = spark.createDataFrame([("flu, rsv",), ("none",), ("rsv",)], "k string")
    assert [tuple(r) for r in ex.top_terms(df, "k").collect()] == [("rsv", 2), ("flu", 1)]


def test_flag_total_and_engagement(spark):
    df = spark.createDataFrame([(True, 2, 1), (False, 3, None), (None, None, 4)], "f boolean, likes int, retweets int")
    assert ex.flag_total(df, "f").first()["n"] == 1
    assert tuple(ex.engagement_totals(df).first()) == (5, 5)


def test_peak_uplift(spark):
    monday, tuesday = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(monday, 18.0)] * 6 + [(monday, 3.0)] * 2 + [(tuesday, 5.0)] * 40 + [(None, 18.0)]
    got = ex.peak_uplift(spark.createDataFrame(rows, "visit_date date, arrival_hour double")).first()
    assert got["window_rate"] == 2.0 and got["base_rate"] == 1.0 and got["uplift_pct"] == 100.0


def test_group_stats_join(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "g string, v double")
    got = {r["g"]: r for r in ft.group_stats_join(df, ["g", "absent"], "v").collect()}
    assert (got["a"]["g_mean"], got["a"]["g_count"], got["b"]["g_count"]) == (2.0, 2, 0)
    assert got[None]["g_mean"] is None and got[None]["g_count"] is None
    with pytest.raises(ValueError, match="already exist"):
        ft.group_stats_join(df.withColumn("g_mean", F.lit(1)), ["g"], "v")


def test_features_are_guarded(spark):
    df = spark.range(1)
    assert ft.temporal_features(df).columns == ["id"]
    assert ft.cyclical_features(df).columns == ["id"]
    assert ft.interaction_features(df).columns == ["id"]


def test_interactions_of_nulls(spark):
    df = spark.createDataFrame(
        [(1, 18.0, "65+", 0, None, 10), (1, 24.0, None, None, 1, None), (0, None, "65+", 1, 1, 4)],
        "is_weekend int, arrival_hour double, age_group string, has_insurance int, high_acuity int, month int",
    )
    got = ft.interaction_features(df).select(
        "weekend_evening", "senior_uninsured", "weekend_high_acuity", "is_flu_season"
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1, None, 1), (0, 0, 1, 0), (0, 0, 0, 0)]


def test_all_features_replace_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 4), 99, 1.0)], "visit_date date, month int, v double")
    got = all_features(df, value_cols=["v"], order_by=["visit_date"]).first()
    assert got["month"] == 3 and got["v_lag1"] is None and got["is_flu_season"] == 1


def test_reports_of_one_kind_of_column(spark):
    numbers = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    texts = spark.createDataFrame([("a",), ("b",)], "s string")
    assert "top_values" not in {r["check"] for r in quality_report(numbers).collect()}
    assert "numeric" not in {r["check"] for r in quality_report(texts).collect()}
    assert ex.summary_stats(texts).count() == 0 and ex.correlations(numbers).count() == 0
    assert ql.categorical_report(numbers).count() == 0


def test_correlations_with_a_large_value_beside_a_gap(spark):
    rows = [(1e7, None, 1.0), (1.0, 1.0, float("inf")), (2.0, 4.0, 3.0), (3.0, 9.0, None), (4.0, 16.0, 2.0), (5.0, 25.0, 9.0)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    found = {(r["var1"], r["var2"]): r["correlation"] for r in ex.correlations(df).collect()}
    assert found["x", "y"] == pytest.approx(0.9811049102515929)
    assert found["x", "z"] is None and found["y", "z"] is None
    assert [r["var2"] for r in ex.strong_correlations(df, 0.5).collect()] == ["y"]
    one_at_a_time = {(r["var1"], r["var2"]): r["correlation"] for r in ex.correlations(df, pairs_per_pass=1).collect()}
    assert one_at_a_time == pytest.approx(found)
    assert "Python" not in ex.correlations(df)._jdf.queryExecution().toString()


def test_wide_correlations_with_large_values_beside_gaps(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(500, 9)), columns=list("abcdefghi"))
    pdf["b"] = pdf["a"] + pdf["b"] / 1e3 + 1e9
    for k, n in enumerate("acdef"):
        pdf.loc[rng.random(500) < 0.3, n] = np.nan
        pdf.loc[k, n] = 1e12
        pdf.loc[k, list("ghi")] = np.nan
    pdf.loc[400:, "i"] = np.nan  # some tasks have no row of a pair
    df = spark.createDataFrame(pdf).repartition(7)
    wide, native = ({(r["var1"], r["var2"]): r["correlation"] for r in ex.correlations(df, pairs_per_pass=p).collect()} for p in (5, 100))
    assert len(wide) == 36 and None not in wide.values()
    assert wide == pytest.approx(native, rel=1e-6, abs=1e-9)
    want = pdf[["a", "g"]].dropna().corr().loc["a", "g"]
    assert wide["a", "g"] == pytest.approx(want, abs=1e-12)
