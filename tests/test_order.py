"""Exact quantiles, ranks, lags and rolling values against plain computations."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caretide.operators import ranks, sequence
from caretide.operators.quantiles import (
    approx_quantiles,
    exact_quantiles,
    grouped_quantiles,
    quantile_table,
    quantiles,
)

PROBS = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]


def _values(kind):
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(5000)],
        "ties": [float(rng.randrange(5)) for _ in range(5000)],
        "hot": [3.0] * 3000 + [rng.gauss(3, 1) for _ in range(2000)],
        "two_hot": [1.0] * 2000 + [2.0] * 2000 + [rng.random() * 3 for _ in range(1500)],
        "skewed": [math.exp(rng.gauss(0, 4)) for _ in range(4000)],
        "flat": [7.0] * 100,
        "single": [5.0],
        "pair": [1.0, 2.0],
        "gaps": [None, math.nan, 1.0, 4.0, None],
        "infinite": [-math.inf, 1.0, 2.0, math.inf],
    }[kind]


@pytest.mark.parametrize(
    "kind", ["uniform", "ties", "hot", "two_hot", "skewed", "flat", "single", "pair", "gaps"]
)
def test_exact_quantiles_with_small_sketches(spark, kind):
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = exact_quantiles(df, {"v": PROBS}, sketch_rows=1000, accuracy=100, lookup_rows=30)["v"]
    clean = [v for v in values if v is not None and not math.isnan(v)]
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(clean, p), rel=1e-12), (kind, p)


def test_grouped_quantiles_with_small_sketches(spark):
    kinds = ["uniform", "ties", "hot", "two_hot", "skewed", "flat", "single", "pair", "gaps", "infinite"]
    rows = [(k, len(k), v) for k in kinds for v in _values(k)] + [("none", 4, None), (None, None, 2.0), (None, None, 4.0)]
    df = spark.createDataFrame(rows, "`v` string, `p` int, `g0.x` double").repartition(5)
    out = grouped_quantiles(df, ["v", "p"], "g0.x", PROBS, grid=16, lookup_rows=200)
    assert out.columns == ["v", "p", "p", "value"]
    got = {(r[0], r[2]): r[3] for r in out.collect()}
    assert len(got) == (len(kinds) + 2) * len(PROBS)
    for k in kinds[:-1]:
        clean = [v for v in _values(k) if v is not None and not math.isnan(v)]
        for p in PROBS:
            assert got[k, p] == pytest.approx(np.quantile(clean, p), rel=1e-12), (k, p)
    assert got["infinite", 0.0] == -math.inf and got["infinite", 0.5] == 1.5 and got["infinite", 1.0] == math.inf
    assert got[None, 0.5] == 3.0 and got["none", 0.5] is None
    assert grouped_quantiles(df.limit(0), ["v"], "g0.x", [0.5]).count() == 0
    with pytest.raises(ValueError):
        grouped_quantiles(df, [], "g0.x", [0.5])


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, {"v": [0.5]})["v"][0.5] is None
    assert approx_quantiles(df, {"v": [0.5]})["v"][0.5] is None


def test_quantiles_equal_percentile(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    got = exact_quantiles(lines, {"l_extendedprice": PROBS})["l_extendedprice"]
    want = lines.agg(F.percentile("l_extendedprice", PROBS)).first()[0]
    assert [got[p] for p in PROBS] == pytest.approx(want)


def test_quantile_methods(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert quantiles(df, {"v": [0.5]}, "approx")["v"][0.5] == 50.0
    assert quantile_table(df, ["v"], [0.25]).first()["value"] == 25.0
    with pytest.raises(ValueError, match="method"):
        quantiles(df, {"v": [0.5]}, "guess")
    with pytest.raises(ValueError, match="accuracy"):
        exact_quantiles(df, {"v": [0.5]}, accuracy=5)


def test_value_ranks_share_ties(spark):
    values = [3.0, 1.0, 3.0, 3.0, 2.0, None, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["value"]: (r["n"], r["mid_rank"]) for r in ranks.value_ranks(df, "v").collect()}
    assert got == {1.0: (1, 1.0), 2.0: (1, 2.0), 3.0: (3, 4.0)}


def test_running_totals_over_many_parts(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(10)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, n int")
    got = ranks.running_totals(df, [F.col("k").desc()], ["n"], parts=9).collect()
    below = 0
    for row in sorted(got, key=lambda r: -r["k"]):
        assert row["n_before"] == below
        below += row["n"]
    assert len(got) == 500


def _series(rows, keys):
    rng = random.Random(rows)
    data = [
        (i, rng.randrange(keys), rng.choice([None, math.nan, *[rng.random()] * 8])) for i in range(rows)
    ]
    rng.shuffle(data)
    return data


def _expected(data, by_key):
    pdf = pd.DataFrame(data, columns=["i", "k", "v"]).sort_values("i")
    groups = [g for _, g in pdf.groupby("k")] if by_key else [pdf]
    parts = []
    for g in groups:
        g = g.copy()
        for n in (1, 5):
            g[f"v_lag{n}"] = g["v"].shift(n)
        for w in (3, 7):
            r = g["v"].rolling(w)
            for name in ("mean", "std", "max", "min"):
                g[f"v_rolling_{name}_{w}d"] = getattr(r, name)()
        parts.append(g)
    return pd.concat(parts).sort_values("i").reset_index(drop=True)


@pytest.mark.parametrize(
    ("rows", "keys", "by_key", "how"),
    [
        (200, 3, False, {"parts": 1}),
        (200, 3, False, {"parts": 17}),
        (40, 2, False, {"parts": 40}),
        (5, 1, False, {"parts": 4}),
        (200, 3, True, {}),
        (200, 3, True, {"rows_per_task": 1, "parts": 13}),
        (200, 1, True, {"rows_per_task": 50, "parts": 11}),
        (200, 3, True, {"daily": True}),
    ],
)
def test_lag_and_rolling_equal_pandas(spark, rows, keys, by_key, how):
    data = _series(rows, keys)
    df = spark.createDataFrame(data, "i int, k int, v double").repartition(4)
    out = sequence.lag_and_rolling(
        df, ["v", "absent"], ["i"], ["k"] if by_key else [], lags=(1, 5), windows=(3, 7), **how
    )
    got = out.toPandas().sort_values("i").reset_index(drop=True)
    want = _expected(data, by_key)
    assert len(got) == rows and not [c for c in got.columns if c.startswith("__")]
    for c in want.columns:
        np.testing.assert_allclose(
            got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-6, atol=1e-7, err_msg=c
        )


def test_separate_lags_and_rolling(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "i int, v double")
    lag = sequence.lagged_features(df, ["v"], ["i"], lags=(2,))
    assert lag.filter("i = 5").first()["v_lag2"] == 3.0
    roll = sequence.rolling_features(df, ["v"], ["i"], windows=(4,))
    assert roll.filter("i = 5").first()["v_rolling_mean_4d"] == 3.5
    assert sequence.lagged_features(df, ["absent"], ["i"]).columns == df.columns
    with pytest.raises(ValueError, match="missing"):
        sequence.lagged_features(df, ["v"], ["absent"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_in_unkeyed_features(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = _plan(sequence.lag_and_rolling(events, ["value"], ["ts", "event_id"], parts=4))
    assert "SinglePartition" not in plan
    naive = events.withColumn("x", F.lag("value").over(Window.orderBy("ts")))
    assert "SinglePartition" in _plan(naive)


def test_rank_helper_orders_only_partition_totals(spark, small):
    """The one single-partition step works on one row per partition."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = _plan(ranks.value_ranks(lines, "l_quantity"))
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1 and "BroadcastHashJoin" in plan


def test_odd_column_names(spark):
    df = spark.createDataFrame([(i, float(i), "k") for i in range(30)], "`row id` int, `a.b c` double, `k.1` string")
    out = sequence.lag_and_rolling(df, ["a.b c"], ["row id"], ["k.1"], lags=(1,), windows=(2,), rows_per_task=1, parts=3)
    assert out.filter("`row id` = 9").first()["a.b c_lag1"] == 8.0
    assert ranks.value_ranks(df, "a.b c").count() == 30
    assert exact_quantiles(df, {"a.b c": [0.5]})["a.b c"][0.5] == 14.5


def test_quantiles_with_infinite_values(spark):
    from caretide.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "x double")
    assert exact_quantiles(df, {"x": [0.5, 1.0]})["x"] == {0.5: 2.0, 1.0: float("inf")}
