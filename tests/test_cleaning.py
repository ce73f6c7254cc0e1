"""Imputation, duplicates, clipping, outliers and the two cleaning chains."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from caretide.operators import cleaning as cl
from caretide.operators import schema as sc
from caretide.plans.clean import clean_feed, clean_visits, derive_visits


def test_modes_prefer_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    assert cl.modes(df, ["x", "y"]) == {"x": "a", "y": None}


def test_impute(spark):
    rows = [(1, 1.0, "b", None), (2, math.nan, "a", None), (None, 3.0, None, None), (4, 10.0, "a", None)]
    out = cl.impute(spark.createDataFrame(rows, "n int, x double, s string, e string"))
    got = [tuple(r) for r in out.orderBy("n", "x").collect()]
    assert dict(out.dtypes)["n"] == "int"  # its median is whole
    assert got.count((2, 3.0, "a", "Unknown")) == 2
    assert {r[3] for r in got} == {"Unknown"} and not any(v is None for r in got for v in r)


def test_impute_and_clipping_keep_large_integers(spark):
    rows = [(2**53 + 1 + k, k, None if k == 3 else k, None if k == 5 else 2**60 + k) for k in range(6)]
    df = spark.createDataFrame(rows, "id bigint, n int, half int, wide bigint")
    out = cl.impute(df)
    assert dict(out.dtypes) == {"id": "bigint", "n": "int", "half": "int", "wide": "bigint"}
    got = out.orderBy("n").collect()
    assert [r["id"] for r in got] == [r[0] for r in rows] and [r["wide"] for r in got[:5]] == [r[3] for r in rows[:5]]
    assert cl.drop_exact_duplicates(out).count() == 6
    odd = cl.impute(spark.createDataFrame([(1,), (2,), (None,)], "n int"))
    assert dict(odd.dtypes)["n"] == "double" and sorted(r[0] for r in odd.collect()) == [1.0, 1.5, 2.0]
    clipped = cl.winsorize_upper(df, columns=["id", "n"])
    assert dict(clipped.dtypes)["id"] == "bigint"
    assert [r["id"] for r in clipped.orderBy("n").limit(5).collect()] == [r[0] for r in rows[:5]]


def test_impute_keeps_all_null_number(spark):
    out = cl.impute(spark.createDataFrame([(None, "a"), (None, "b")], "n int, s string"))
    assert [r["n"] for r in out.collect()] == [None, None]


def test_impute_boolean(spark):
    out = cl.impute(spark.createDataFrame([(True,), (None,), (True,), (False,)], "b boolean"))
    assert sorted(r[0] for r in out.collect()) == [False, True, True, True]


def test_impute_before_duplicates(spark):
    """Filling a gap can create a copy, which is then removed."""
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, "a"), (1, "b")], "n int, s string")
    assert cl.drop_exact_duplicates(cl.impute(df)).count() == 2


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "n int, s string")
    assert cl.drop_exact_duplicates(df).count() == 2


def test_winsorize_keeps_nulls_and_zeroes_rare_flags(spark):
    rows = [(float(i), 1 if i == 0 else 0, 7, None if i % 2 else float(i)) for i in range(1000)]
    out = cl.winsorize_upper(spark.createDataFrame(rows, "x double, rare int, flat int, gaps double"))
    top, rare, flat, nulls = out.agg(
        F.max("x"), F.max("rare"), F.min("flat"), F.count_if(F.col("gaps").isNull())
    ).first()
    assert top == pytest.approx(989.01) and rare == 0 and flat == 7 and nulls == 500


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100, -50]] + [(None,)], "v double")
    assert sorted(r[0] for r in cl.iqr_outliers(df, "v").collect()) == [-50.0, 100.0]
    one = cl.iqr_outlier_summary(df, "v").first()
    assert one["n_outliers"] == 2 and one["pct_outliers"] == pytest.approx(25.0)
    assert (one["lower_bound"], one["upper_bound"]) == (-3.0, 9.0)


def test_outliers_of_empty_and_single(spark):
    empty = spark.createDataFrame([], "v double")
    assert cl.iqr_outliers(empty, "v").count() == 0
    assert cl.iqr_outlier_summary(empty, "v").first()["pct_outliers"] is None
    assert cl.iqr_outliers(spark.createDataFrame([(3.0,)], "v double"), "v").count() == 0


def test_keep_first_follows_the_given_order(spark):
    df = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("m", 5, "z")], "k string, o int, v string")
    assert {r["v"] for r in cl.keep_first(df, ["k"], ["o"]).collect()} == {"y", "z"}
    with pytest.raises(ValueError, match="missing"):
        cl.keep_first(df, ["absent"], ["o"])


def test_keep_first_cuts_hot_keys_before_the_shuffle(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = cl.keep_first(events, ["event_type"], ["event_id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_feed_uses_text_without_title(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, day, "a", "t"), (2, day, "b", "t"), (3, day, "a", "u")]
    df = spark.createDataFrame(rows, "id int, date timestamp, text string, title string")
    assert sorted(r["id"] for r in cl.dedup_feed(df, ["id"]).collect()) == [1, 3]
    assert sorted(r["id"] for r in cl.dedup_feed(df.drop("title"), ["id"]).collect()) == [1, 2]


def test_polarity_range(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 1.0, 1.01, None, math.nan)], "sentiment_polarity double")
    assert sorted(r[0] for r in cl.polarity_range(df).collect()) == [-1.0, 1.0]


def test_since_and_lookback(spark):
    rows = [(dt.datetime(2024, 1, 3, 0, 0),), (dt.datetime(2024, 1, 2, 23, 59),), (dt.datetime(2024, 1, 3, 12),)]
    df = spark.createDataFrame(rows, "date timestamp")
    assert cl.since_filter(df, "2024-01-10 12:00:00", 7).count() == 2
    assert cl.lookback_filter(df, "2024-01-10 12:00:00", 7).count() == 1


def test_strip_diagnosis_keeps_null(spark):
    out = cl.strip_diagnosis(spark.createDataFrame([(" a ", 1), (None, 2)], "DIAG1 string, x int"))
    assert [r[0] for r in out.orderBy("x").collect()] == ["a", None]


def test_derive_visits_guards_missing_columns(spark):
    out = derive_visits(spark.createDataFrame([(1,)], "AGE int"))
    assert out.columns == ["AGE", "age_group"]


def test_clean_visits_order(spark):
    """Null VDATE takes the mode before parsing; derived flags are clipped too."""
    rows = [("01012024", 30, "2400", 1, 5, " A ")] * 3 + [
        (None, None, "0930", None, None, None),
        ("bad", 70, "xx", 3, 1, "B"),
    ]
    df = spark.createDataFrame(rows, "VDATE string, AGE int, ARRTIME string, IMMEDR int, PAYTYPER int, DIAG1 string")
    out = {r["ARRTIME"]: r.asDict() for r in clean_visits(df).collect()}
    assert len(out) == 3
    assert out["0930"]["visit_date"] == dt.date(2024, 1, 1) and out["0930"]["DIAG1"] == "A"
    assert out["2400"]["time_of_day"] is None and out["xx"]["arrival_hour"] is None
    assert out["xx"]["visit_date"] is None and out["xx"]["is_weekend"] == 0.0
    assert out["xx"]["age_group"] == "65+"


def test_clean_feed_lower_copy_keeps_edges(spark):
    day = dt.datetime(2024, 1, 7, 5)
    rows = [
        (1, day, " Title ", " Body ", 0.5), (2, day, "Title", "x", 0.1), (3, day, "T2", "  ", 0.1),
        (4, None, "T3", "x", 0.1), (5, day, "T4", "x", 1.5), (6, day, "T5", None, 0.0),
    ]
    df = spark.createDataFrame(rows, "id int, date timestamp, title string, text string, sentiment_polarity double")
    out = clean_feed(df, ["id"]).collect()
    assert [r["id"] for r in out] == [1]
    assert (out[0]["title"], out[0]["title_lower"], out[0]["day_of_week"]) == ("Title", " title ", 6)


def test_clean_feed_parses_text_dates(spark):
    df = spark.createDataFrame([("2024-01-02", "a"), ("no", "b")], "date string, text string")
    assert clean_feed(df, ["text"]).count() == 1


def test_require_columns(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(day, "t", "c")], "date timestamp, title string, content string")
    assert sc.is_valid(df, ["date", "title", "content"])
    assert not sc.is_valid(df.drop("content"), ["date", "title", "content"])
    assert not sc.is_valid(spark.createDataFrame([], "date timestamp"), ["date"])
    bad = {r["column"]: r for r in sc.require_columns(df, ["date", "absent"]).collect()}
    assert bad["absent"]["present"] is False and bad["date"]["valid"] is False
    assert sc.require_columns(df, ["date"]).first()["valid"] is True


def test_new_columns(spark):
    df = spark.range(1)
    assert sc.new_columns(df, df.withColumn("x", F.lit(1))) == ["x"]


def test_nan_to_null(spark):
    out = sc.nan_to_null(spark.createDataFrame([(math.nan, 1)], "x double, y int"))
    assert tuple(out.first()) == (None, 1)
