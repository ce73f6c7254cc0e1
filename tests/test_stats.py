"""Tests against brute force, published tables and numpy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretide.functions import tails
from caretide.operators import explore as ex
from caretide.operators import hypothesis as hy
from caretide.operators.kendall import _merge_score, kendall_counts


def _groups(spark):
    rows = [("a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("b", v) for v in (3.0, 5.0, 7.0, 9.0, 11.0)]
    return spark.createDataFrame([*rows, ("a", None), ("b", math.nan), ("c", 100.0)], "g string, v double")


def test_ttest_ind(spark):
    row = hy.ttest_ind(_groups(spark), "v", "g", ("a", "b")).first()
    a, b = np.array([1, 2, 3, 4.0]), np.array([3, 5, 7, 9, 11.0])
    pooled = (3 * a.var(ddof=1) + 4 * b.var(ddof=1)) / 7
    assert row["statistic"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled * (1 / 4 + 1 / 5)))
    assert row["dof"] == 7 and row["effect_size"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled))
    t = np.linspace(abs(row["statistic"]), 2000, 2_000_001)
    density = math.gamma(4) / (math.sqrt(7 * math.pi) * math.gamma(3.5)) * (1 + t * t / 7) ** -4
    assert row["p_value"] == pytest.approx(2 * np.trapezoid(density, t), abs=1e-6) and row["significant"]
    assert hy.cohens_d(_groups(spark), "v", "g", ("a", "b")).first()[0] == row["effect_size"]


def test_ttest_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, v double")
    row = hy.ttest_ind(df, "v", "g", ("a", "b")).first()
    assert row["statistic"] is None and row["effect_size"] is None and row["significant"] is False


def test_ttest_paired(spark):
    x, y = [1.0, 2.0, 3.0, 5.0], [2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([*zip(x, y), (1.0, None)], "x double, y double")
    row = hy.ttest_paired(df, "x", "y").first()
    gap = np.subtract(x, y)
    assert row["statistic"] == pytest.approx(gap.mean() / (gap.std(ddof=1) / 2)) and row["dof"] == 3
    pooled = math.sqrt((np.var(x, ddof=1) + np.var(y, ddof=1)) / 2)
    assert row["effect_size"] == pytest.approx((np.mean(x) - np.mean(y)) / pooled)


def _cells(spark, table):
    rows = [(i, j) for i, line in enumerate(table) for j, n in enumerate(line) for _ in range(n)]
    return spark.createDataFrame([*rows, (None, 0)], "a int, b int")


def test_chi2_with_empty_cells(spark):
    table = [[10, 0, 5], [3, 8, 4]]
    row = hy.chi2_contingency(_cells(spark, table), "a", "b").first()
    t = np.array(table, float)
    e = np.outer(t.sum(1), t.sum(0)) / t.sum()
    assert row["statistic"] == pytest.approx(((t - e) ** 2 / e).sum()) and row["dof"] == 2


def test_chi2_yates(spark):
    """Against the closed form for a 2 x 2 table."""
    row = hy.chi2_contingency(_cells(spark, [[12, 5], [3, 7]]), "a", "b").first()
    assert row["statistic"] == pytest.approx(27 * (69 - 13.5) ** 2 / (17 * 10 * 15 * 12)) and row["dof"] == 1
    plain = hy.chi2_contingency(_cells(spark, [[12, 5], [3, 7]]), "a", "b", correction=False).first()
    assert plain["statistic"] == pytest.approx(27 * 69**2 / (17 * 10 * 15 * 12))
    v = hy.cramers_v(_cells(spark, [[12, 5], [3, 7]]), "a", "b").first()
    assert v["cramers_v"] == pytest.approx(math.sqrt(plain["statistic"] / 27))


def test_chi2_of_one_row(spark):
    row = hy.chi2_contingency(_cells(spark, [[4, 6]]), "a", "b").first()
    assert (row["statistic"], row["dof"], row["p_value"]) == (0.0, 0, 1.0)


def test_chi2_goodness(spark):
    o = spark.createDataFrame([("x", 16), ("y", 18), ("z", 16), ("u", 14), ("v", 12), ("w", 12)], "k string, n int")
    e = o.select("k", F.when(F.col("k") == "u", 16.0).otherwise(14.4).alias("n"))
    with pytest.raises(ValueError, match="agree"):
        hy.chi2_goodness(o, e.withColumn("n", F.col("n") + 1), "k")
    row = hy.chi2_goodness(o, e, "k").first()
    want = (1.6**2 + 3.6**2 + 1.6**2 + 2 * 2.4**2) / 14.4 + 4 / 16
    assert row["statistic"] == pytest.approx(want) and row["dof"] == 5


def test_anova(spark):
    groups = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    row = hy.anova_oneway(df, "v", "g").first()
    assert row["statistic"] == pytest.approx(9.264706, abs=1e-6)
    assert (row["dof_between"], row["dof_within"]) == (2, 15)
    assert row["p_value"] == pytest.approx(0.0023987, abs=1e-6)


def _ranks(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def _tau_b(x, y):
    s = dx = dy = 0
    for (a, b), (c, d) in itertools.combinations(zip(x, y), 2):
        s += np.sign(a - c) * np.sign(b - d)
        dx += a != c
        dy += b != d
    return s / math.sqrt(dx * dy)


@pytest.mark.parametrize("seed", [1, 2])
def test_correlations_with_ties(spark, seed):
    rng = random.Random(seed)
    x = [float(rng.randrange(8)) for _ in range(80)]
    y = [float(round(v + rng.gauss(0, 3))) for v in x]
    df = spark.createDataFrame([*zip(x, y), (None, 1.0), (2.0, math.nan)], "x double, y double")
    pearson = hy.correlation_test(df, "x", "y").first()
    assert pearson["correlation"] == pytest.approx(np.corrcoef(x, y)[0, 1]) and pearson["n"] == 80
    spearman = hy.correlation_test(df, "x", "y", "spearman").first()
    assert spearman["correlation"] == pytest.approx(np.corrcoef(_ranks(x), _ranks(y))[0, 1])
    kendall = hy.correlation_test(df, "x", "y", "any other name").first()
    assert kendall["correlation"] == pytest.approx(_tau_b(x, y)) and kendall["method"] == "kendall"


def test_perfect_and_constant_correlation(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0) for i in range(20)], "x double, y double, c double")
    for method in ("pearson", "spearman", "kendall"):
        row = hy.correlation_test(df, "x", "y", method).first()
        assert row["correlation"] == pytest.approx(1.0) and row["significant"]
        assert hy.correlation_test(df, "x", "c", method).first()["correlation"] is None


def test_kendall_p_value(spark):
    """Twelve pairs without ties: the normal approximation by hand."""
    y = [1, 3, 2, 5, 4, 7, 6, 9, 8, 11, 10, 12]
    df = spark.createDataFrame([(float(i), float(v)) for i, v in enumerate(y)], "x double, y double")
    row = hy.corr_kendall(df, "x", "y").first()
    s = 66 - 2 * 5
    var = 12 * 11 * 29 / 18
    assert row["correlation"] == pytest.approx(s / 66)
    assert row["p_value"] == pytest.approx(math.erfc(s / math.sqrt(2 * var)))


@pytest.mark.parametrize("shape", ["spread", "hot_x", "hot_both", "grid"])
def test_kendall_buckets_equal_brute_force(spark, shape):
    rng = random.Random(5)
    pairs = {
        "spread": [(rng.random(), rng.random()) for _ in range(700)],
        "hot_x": [(3.0, rng.random()) for _ in range(400)] + [(rng.random() * 6, rng.random()) for _ in range(300)],
        "hot_both": [(3.0, 4.0)] * 300 + [(float(rng.randrange(6)), rng.random() * 8) for _ in range(400)],
        "grid": [(float(rng.randrange(30)), float(rng.randrange(30))) for _ in range(700)],
    }[shape]
    df = spark.createDataFrame(pairs, "x double, y double").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    got = kendall_counts(df.persist(), small=60)
    x, y = (np.array(v) for v in zip(*pairs))
    want = int((np.sign(x[:, None] - x) * np.sign(y[:, None] - y)).sum()) // 2
    assert got.score == want and got.n == len(pairs)
    assert got.x_ties == sum(int(t) * (int(t) - 1) // 2 for t in np.unique(x, return_counts=True)[1])


def test_merge_score_with_large_weights():
    x, y, n = np.array([1.0, 2.0]), np.array([1.0, 2.0]), np.array([10**10, 10**10])
    assert _merge_score(x, y, n) == 10**20


def test_normality(spark, small):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(size=2000), rng.exponential(size=2000))], "a double, b double")
    normal, skewed = (hy.normality(df, c).first() for c in ("a", "b"))
    assert normal["is_normal"] and normal["ks_p_value"] > 0.05
    assert not skewed["is_normal"] and skewed["ks_p_value"] < 0.05
    for constant in (7.0, 0.1):
        flat = hy.normality(df.withColumn("c", F.lit(constant)), "c").first()
        assert flat["statistic"] is None and flat["is_normal"] is None


def test_constants_and_no_rows(spark):
    df = spark.createDataFrame([(0.1, float(k), "g") for k in range(31)], "c double, v double, g string")
    assert hy.corr_pearson(df, "c", "v").first()["correlation"] is None or math.isnan(hy.corr_pearson(df, "c", "v").first()["correlation"])
    shape = {(r["column"], r["metric"]): r["value"] for r in ex.distribution_stats(df, ["c"]).collect()}
    assert shape["c", "skewness"] == 0 and shape["c", "kurtosis"] == 0
    none = hy.anova_oneway(df.limit(0), "v", "g").first()
    assert none["statistic"] is None or math.isnan(none["statistic"])


@pytest.mark.parametrize("df", [1e6, 1e7, 1e9, 1e13])
def test_tails_at_size(df):
    assert tails.t_two_sided(2.0, df) == pytest.approx(0.04550026, rel=1e-5)
    assert tails.f_sf(1.0, 5, df) == pytest.approx(0.4158802, rel=1e-5)
    assert tails.chi2_sf(df, df) == pytest.approx(0.5 - 1 / (3 * math.sqrt(math.pi * df)), abs=1e-6)
    assert tails.f_sf(1.0, df, df) == pytest.approx(0.5, abs=1e-6)


def test_two_by_two(spark):
    rows = [(True, True)] * 20 + [(True, False)] * 10 + [(False, True)] * 5 + [(False, False)] * 15 + [(None, True)]
    df = spark.createDataFrame(rows, "e boolean, o boolean")
    got = hy.odds_ratio(df, F.col("e"), F.col("o")).first()
    reach = 1.959963985 * math.sqrt(1 / 20 + 1 / 10 + 1 / 5 + 1 / 15)
    assert got["odds_ratio"] == 6.0 and got["ci_lower"] == pytest.approx(6 * math.exp(-reach))
    assert hy.rate_ratio(df, F.col("e"), F.col("o")).first()["rate_ratio"] == pytest.approx((20 / 30) / (5 / 20))
    none = hy.odds_ratio(df.filter("e"), F.col("e"), F.col("o")).first()
    assert none["odds_ratio"] is None and none["ci_upper"] is None


def test_cross_correlation_finds_the_lag(spark):
    rng = random.Random(3)
    x = [rng.random() for _ in range(60)]
    rows = [(i, x[i], x[i - 3] if i >= 3 else 0.5) for i in range(60)]
    got = hy.cross_correlation(spark.createDataFrame(rows, "day int, x double, y double"), "x", "y", 5).collect()
    assert max(got, key=lambda r: r["r"])["lag"] == 3 and got[3]["r"] == pytest.approx(1.0)


def test_granger(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = np.r_[0, 0, 0.9 * x[:-2]] + rng.normal(size=200) * 0.3
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "day int, x double, y double")
    got = hy.granger(df, "x", "y", 2).first()
    own = np.c_[np.ones(198), y[1:-1], y[:-2]]
    full = np.c_[own, x[1:-1], x[:-2]]
    ssr = [float(((y[2:] - m @ np.linalg.lstsq(m, y[2:], rcond=None)[0]) ** 2).sum()) for m in (own, full)]
    want = ((ssr[0] - ssr[1]) / 2) / (ssr[1] / (198 - 5))
    assert got["statistic"] == pytest.approx(want, rel=1e-6) and got["significant"]
    assert not hy.granger(df, "y", "x", 2).first()["p_value"] < 1e-4


def test_spike_alert(spark):
    rows = [(i, 10.0 if i != 9 else 25.0) for i in range(12)]
    got = hy.spike_alert(spark.createDataFrame(rows, "day int, v double"), "v").orderBy("day").collect()
    assert [r["day"] for r in got if r["alert"]] == [9]
    assert got[6]["baseline"] is None and got[7]["baseline"] == 10.0


def test_tests_of_empty_tables_have_no_statistic(spark):
    counts = spark.createDataFrame([], "k string, n bigint")
    found = hy.chi2_goodness(counts, counts, "k").first()
    assert found["statistic"] is None or found["statistic"] != found["statistic"]
    daily = spark.createDataFrame([], "day date, x double, y double")
    for rows in (daily, spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 1.0)], "day int, x double, y double")):
        found = hy.granger(rows, "x", "y").first()
        assert found["statistic"] is None or found["statistic"] != found["statistic"]
