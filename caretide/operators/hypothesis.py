"""Hypothesis tests: sufficient statistics in Spark, tail probabilities of the result.

Every test returns one row. Missing values (NULL, NaN) are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from caretide.functions import tails
from caretide.functions.columns import finite
from caretide.operators.explore import pearson
from caretide.operators.kendall import kendall_counts
from caretide.operators.ranks import value_ranks
from caretide.operators.schema import col
from caretide.session import materialize

ALPHA = 0.05


def _one(spark: SparkSession, **fields) -> DataFrame:
    """A one-row frame; floats DOUBLE, ints BIGINT, NaN becomes NULL."""
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    values, types = [], []
    for name, value in fields.items():
        if isinstance(value, float) and math.isnan(value):
            value = None
        types.append(f"{name} {kinds.get(type(value), 'double')}")
        values.append(value)
    return spark.createDataFrame([tuple(values)], ", ".join(types))


def _ratio(a: float | None, b: float | None) -> float:
    return a / b if a is not None and b else math.nan


def _verdict(p: float, alpha: float) -> dict:
    return {"p_value": p, "significant": bool(p < alpha)}


def _pooled_d(n1, m1, v1, n2, m2, v2) -> float:
    if n1 + n2 <= 2 or v1 is None or v2 is None:
        return math.nan
    return _ratio(m1 - m2, math.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)))


def _group_moments(df: DataFrame, value: str, group: str, groups: Sequence) -> list[Row]:
    x = finite(col(value))
    aggregates = []
    for i, g in enumerate(groups):
        mine = F.when(col(group) == F.lit(g), x)
        aggregates += [
            F.count(mine).alias(f"n{i}"),
            F.avg(mine).alias(f"m{i}"),
            F.var_samp(mine).alias(f"v{i}"),
        ]
    r = df.agg(*aggregates).first()
    return [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for i in range(len(groups))]


def ttest_ind(
    df: DataFrame, value: str, group: str, groups: tuple, alpha: float = ALPHA
) -> DataFrame:
    """Student's t with equal variances between two groups, with Cohen's d."""
    (n1, m1, v1), (n2, m2, v2) = _group_moments(df, value, group, groups)
    dof = n1 + n2 - 2
    stat = math.nan
    if n1 > 1 and n2 > 1:
        pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / dof
        stat = _ratio(m1 - m2, math.sqrt(pooled * (1 / n1 + 1 / n2)))
    p = math.nan if math.isnan(stat) else tails.t_two_sided(stat, dof)
    return _one(
        df.sparkSession,
        statistic=stat,
        dof=dof,
        **_verdict(p, alpha),
        effect_size=_pooled_d(n1, m1, v1, n2, m2, v2),
    )


def ttest_paired(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """Paired t of two columns; the effect size uses the two-sample formula."""
    x, y = finite(col(a)), finite(col(b))
    both = x.isNotNull() & y.isNotNull()
    gap = x - y
    r = df.filter(both).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(gap).alias("m"),
        F.stddev_samp(gap).alias("s"),
        *[f(v).alias(n) for v, k in ((x, "x"), (y, "y")) for f, n in ((F.avg, f"m{k}"), (F.var_samp, f"v{k}"))],
    ).first()
    n = r["n"]
    stat = _ratio(r["m"], r["s"] / math.sqrt(n)) if n > 1 else math.nan
    p = math.nan if math.isnan(stat) else tails.t_two_sided(stat, n - 1)
    return _one(
        df.sparkSession,
        statistic=stat,
        dof=n - 1,
        **_verdict(p, alpha),
        effect_size=_pooled_d(n, r["mx"], r["vx"], n, r["my"], r["vy"]),
    )


def cohens_d(df: DataFrame, value: str, group: str, groups: tuple) -> DataFrame:
    """Standardised mean difference with pooled deviation; null if that is 0."""
    a, b = _group_moments(df, value, group, groups)
    return _one(df.sparkSession, effect_size=_pooled_d(*a, *b))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(a, b, n)``: observed counts of the value pairs that occur."""
    return (
        df.filter(col(a).isNotNull() & col(b).isNotNull())
        .groupBy(col(a).alias("a"), col(b).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _chi2(cells: DataFrame) -> tuple[float, int, int, int]:
    """Uncorrected chi-square, rows, columns and total of a table of counts.

    Cells that do not occur add their expected count, which is what the expected
    counts of the occurring cells leave of the total.
    """
    cells = materialize(cells, "cells")
    total, rows, columns = cells.agg(
        F.sum("n"), F.count_distinct("a"), F.count_distinct("b")
    ).first()
    if not total:
        raise ValueError("no observations")
    sums = {c: cells.groupBy(c).agg(F.sum("n").cast("double").alias(f"n_{c}")) for c in ("a", "b")}
    expected = F.col("n_a") * F.col("n_b") / F.lit(float(total))
    e = F.col("e")
    observed, covered = (
        cells.join(sums["a"], "a")
        .join(sums["b"], "b")
        .withColumn("e", expected)
        .agg(F.sum((F.col("n") - e) * (F.col("n") - e) / e), F.sum(e))
        .first()
    )
    return observed + (total - covered), rows, columns, total


def chi2_contingency(
    df: DataFrame, a: str, b: str, alpha: float = ALPHA, correction: bool = True
) -> DataFrame:
    """Test of independence; a 2 x 2 table gets the Yates correction."""
    cells = contingency(df, a, b)
    stat, rows, columns, _ = _chi2(cells)
    dof = (rows - 1) * (columns - 1)
    if dof == 0:
        stat, p = 0.0, 1.0
    else:
        if dof == 1 and correction:
            stat = _yates(cells)
        p = tails.chi2_sf(stat, dof)
    return _one(df.sparkSession, statistic=float(stat), dof=dof, **_verdict(p, alpha))


def _yates(cells: DataFrame) -> float:
    """Corrected statistic of a 2 x 2 table (at most four counts are read)."""
    found = {(r["a"], r["b"]): r["n"] for r in cells.collect()}
    firsts = sorted({k[0] for k in found})
    seconds = sorted({k[1] for k in found})
    table = np.array([[found.get((x, y), 0) for y in seconds] for x in firsts], dtype=float)
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    gap = np.abs(table - expected)
    return float((((gap - np.minimum(0.5, gap)) ** 2) / expected).sum())


def chi2_goodness(
    observed: DataFrame, expected: DataFrame, key: str, alpha: float = ALPHA
) -> DataFrame:
    """Counts ``(key, n)`` against expected counts ``(key, n)``; totals must agree."""
    e = expected.select(col(key).alias("__k"), F.col("n").cast("double").alias("e"))
    o = observed.select(col(key).alias("__k"), F.col("n").cast("double").alias("o"))
    both = e.join(o, "__k", "full").select(
        F.coalesce("o", F.lit(0.0)).alias("o"), F.coalesce("e", F.lit(0.0)).alias("e")
    )
    gap = F.col("o") - F.col("e")
    stat, k, total, wanted, empty = both.agg(
        F.sum(F.try_divide(gap * gap, F.col("e"))),
        F.count(F.lit(1)),
        F.sum("o"),
        F.sum("e"),
        F.count_if((F.col("e") == 0) & (F.col("o") > 0)),
    ).first()
    if not k:  # no category in either table
        return _one(observed.sparkSession, statistic=math.nan, dof=0, **_verdict(math.nan, alpha))
    if empty or abs(total - wanted) > 1e-8 * max(abs(total), abs(wanted)):
        raise ValueError(f"observed total {total} and expected total {wanted} do not agree")
    return _one(
        observed.sparkSession, statistic=stat, dof=k - 1, **_verdict(tails.chi2_sf(stat, k - 1), alpha)
    )


def anova_oneway(df: DataFrame, value: str, group: str, alpha: float = ALPHA) -> DataFrame:
    """One-way analysis of variance over all groups."""
    x = finite(col(value))
    stats = materialize(
        df.filter(x.isNotNull() & col(group).isNotNull())
        .groupBy(col(group).alias("g"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("m"), F.var_samp(x).alias("v")),
        "anova",
    )
    k, n, total = stats.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("m"))).first()
    if not n:
        return _one(df.sparkSession, statistic=math.nan, dof_between=-1, dof_within=0, **_verdict(math.nan, alpha))
    gap = F.col("m") - F.lit(total / n)
    between, within = stats.agg(
        F.sum(F.col("n") * gap * gap), F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0)))
    ).first()
    d1, d2 = k - 1, n - k
    stat = _ratio(between / d1, within / d2) if d1 > 0 and d2 > 0 else math.nan
    p = math.nan if math.isnan(stat) else tails.f_sf(stat, d1, d2)
    return _one(df.sparkSession, statistic=stat, dof_between=d1, dof_within=d2, **_verdict(p, alpha))


def _r_p_value(r: float | None, n: int) -> float:
    if r is None or n < 3:
        return math.nan
    rest = 1.0 - r * r
    return 0.0 if rest <= 0 else tails.t_two_sided(r * math.sqrt((n - 2) / rest), n - 2)


def _correlation(spark, method, r, n, p, alpha) -> DataFrame:
    return _one(
        spark,
        correlation=math.nan if r is None else float(r),
        n=n,
        **_verdict(p, alpha),
        method=method,
    )


def corr_pearson(df: DataFrame, x: str, y: str, alpha: float = ALPHA) -> DataFrame:
    a, b = finite(col(x)), finite(col(y))
    r, n = df.agg(pearson(a, b), F.count_if(a.isNotNull() & b.isNotNull())).first()
    return _correlation(df.sparkSession, "pearson", r, n, _r_p_value(r, n), alpha)


def value_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(x, y, n)``: complete pairs with their number of copies."""
    return (
        df.select(finite(col(x)).alias("x"), finite(col(y)).alias("y"))
        .filter("x is not null and y is not null")
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def corr_spearman(df: DataFrame, x: str, y: str, alpha: float = ALPHA) -> DataFrame:
    """Rank correlation with shared ranks for ties, from counted value pairs."""
    pairs = materialize(value_pairs(df, x, y), "pairs")
    n = pairs.agg(F.sum("n")).first()[0] or 0
    middle = F.lit((n + 1) / 2.0)

    def ranked(name: str) -> DataFrame:
        ranks = value_ranks(pairs, name, "n")
        return ranks.select(F.col("value").alias(name), (F.col("mid_rank") - middle).alias(f"d{name}"))

    both = pairs.join(ranked("x"), "x").join(ranked("y"), "y")
    w, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    sxy, sxx, syy = both.agg(F.sum(w * dx * dy), F.sum(w * dx * dx), F.sum(w * dy * dy)).first()
    r = sxy / math.sqrt(sxx * syy) if n and sxx and syy else None
    return _correlation(df.sparkSession, "spearman", r, n, _r_p_value(r, n), alpha)


def corr_kendall(df: DataFrame, x: str, y: str, alpha: float = ALPHA, **how) -> DataFrame:
    """Kendall's tau-b with the tie-corrected normal p-value."""
    pairs = materialize(value_pairs(df, x, y), "pairs")
    c = kendall_counts(pairs, **how)
    n = c.n
    pairs_total = n * (n - 1) // 2
    spread = (pairs_total - c.x_ties) * (pairs_total - c.y_ties)
    tau = c.score / math.sqrt(spread) if spread else None
    p = math.nan
    if tau is not None:
        m = n * (n - 1.0)
        var = (m * (2 * n + 5) - c.x_ties2 - c.y_ties2) / 18.0 + (
            2.0 * c.x_ties * c.y_ties
        ) / m
        if n > 2:
            var += c.x_ties3 * c.y_ties3 / (9.0 * m * (n - 2))
        p = math.erfc(abs(c.score) / math.sqrt(2.0 * var)) if var > 0 else math.nan
    return _correlation(df.sparkSession, "kendall", tau, n, p, alpha)


def correlation_test(
    df: DataFrame, x: str, y: str, method: str = "pearson", alpha: float = ALPHA
) -> DataFrame:
    """Pearson, Spearman, or Kendall for any other method name."""
    test = {"pearson": corr_pearson, "spearman": corr_spearman}.get(method, corr_kendall)
    return test(df, x, y, alpha)


def normality(df: DataFrame, column: str, alpha: float = ALPHA) -> DataFrame:
    """Jarque-Bera and Kolmogorov-Smirnov against the normal of same mean and deviation.

    ``statistic``, ``p_value`` and ``is_normal`` are those of Jarque-Bera; without two
    different values they are null.
    """
    x = finite(col(column))
    n, skew, kurt, mean, sd, varies = df.agg(
        F.count(x), F.skewness(x), F.kurtosis(x), F.avg(x), F.stddev_samp(x), F.min(x) < F.max(x)
    ).first()
    if not varies:
        return df.sparkSession.createDataFrame(
            [("jarque-bera", None, None, None, None, None)],
            "method string, statistic double, p_value double, is_normal boolean, ks_statistic double, ks_p_value double",
        )
    jb = n / 6.0 * (skew * skew + kurt * kurt / 4.0)
    p = tails.chi2_sf(jb, 2)
    values = df.select(x.alias("x")).filter("x is not null")
    ks = KolmogorovSmirnovTest.test(values, "x", "norm", mean, sd).first()
    return _one(
        df.sparkSession,
        method="jarque-bera",
        statistic=jb,
        p_value=p,
        is_normal=bool(p > alpha),
        ks_statistic=float(ks["statistic"]),
        ks_p_value=float(ks["pValue"]),
    )


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Strength of association from the uncorrected chi-square."""
    stat, rows, columns, total = _chi2(contingency(df, a, b))
    room = total * min(rows - 1, columns - 1)
    return _one(
        df.sparkSession,
        chi2=float(stat),
        n=total,
        cramers_v=math.sqrt(max(0.0, stat) / room) if room else math.nan,
    )


def _two_by_two(df: DataFrame, exposed: Column, outcome: Column) -> tuple[int, int, int, int]:
    known = exposed.isNotNull() & outcome.isNotNull()
    return tuple(
        df.filter(known)
        .agg(
            F.count_if(exposed & outcome),
            F.count_if(exposed & ~outcome),
            F.count_if(~exposed & outcome),
            F.count_if(~exposed & ~outcome),
        )
        .first()
    )


def odds_ratio(
    df: DataFrame, exposed: Column, outcome: Column, confidence: float = 0.95
) -> DataFrame:
    """Odds ratio of two conditions with its log-normal confidence interval."""
    a, b, c, d = _two_by_two(df, exposed, outcome)
    if min(a, b, c, d) == 0:
        ratio = _ratio(float(a * d), b * c)
        low = high = math.nan
    else:
        ratio = a * d / (b * c)
        reach = tails.normal_quantile((1 + confidence) / 2) * math.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
        low, high = ratio * math.exp(-reach), ratio * math.exp(reach)
    return _one(
        df.sparkSession, odds_ratio=ratio, ci_lower=low, ci_upper=high, a=a, b=b, c=c, d=d
    )


def rate_ratio(df: DataFrame, exposed: Column, outcome: Column) -> DataFrame:
    """Rate of the outcome among the exposed over the rate among the others."""
    a, b, c, d = _two_by_two(df, exposed, outcome)
    first, second = _ratio(float(a), a + b), _ratio(float(c), c + d)
    return _one(
        df.sparkSession, rate_exposed=first, rate_other=second, rate_ratio=_ratio(first, second)
    )


def cross_correlation(
    daily: DataFrame, x: str, y: str, max_lag: int = 7, order_by: str = "day"
) -> DataFrame:
    """``(lag, r, n)``: correlation of ``x`` some rows earlier with ``y``.

    For daily tables: one row per day, so the ordering window is bounded.
    """
    w = Window.orderBy(order_by)
    lags = range(max_lag + 1)
    view = daily.select(
        finite(col(y)).alias("y"), *[F.lag(finite(col(x)), k).over(w).alias(f"x{k}") for k in lags]
    )
    one = view.agg(
        *[pearson(F.col(f"x{k}"), F.col("y")).alias(f"r{k}") for k in lags],
        *[
            F.count_if(F.col(f"x{k}").isNotNull() & F.col("y").isNotNull()).alias(f"n{k}")
            for k in lags
        ],
    )
    cells = [
        F.struct(F.lit(k).alias("lag"), F.col(f"r{k}").alias("r"), F.col(f"n{k}").alias("n"))
        for k in lags
    ]
    return one.select(F.inline(F.array(*cells)))


def granger(
    daily: DataFrame, x: str, y: str, lags: int = 3, order_by: str = "day", alpha: float = ALPHA
) -> DataFrame:
    """Does the past of ``x`` help to predict ``y`` beyond the past of ``y``?

    F test of two lag regressions on a daily table; null where the rows are too few for it.
    """
    w = Window.orderBy(order_by)
    steps = range(1, lags + 1)
    own = [f"y{k}" for k in steps]
    other = [f"x{k}" for k in steps]
    view = materialize(
        daily.select(
            finite(col(y)).alias("y"),
            *[F.lag(finite(col(y)), k).over(w).alias(f"y{k}") for k in steps],
            *[F.lag(finite(col(x)), k).over(w).alias(f"x{k}") for k in steps],
        ).na.drop(),
        "granger",
    )
    n = view.count()

    def residual(features: list[str]) -> float:
        data = VectorAssembler(inputCols=features, outputCol="features").transform(view)
        fit = LinearRegression(labelCol="y", solver="normal", regParam=0.0).fit(data)
        return fit.summary.meanSquaredError * n

    d2 = n - 2 * lags - 1
    stat = math.nan
    if d2 > 0:
        small, full = residual(own), residual(own + other)
        stat = _ratio((small - full) / lags, full / d2)
    p = math.nan if math.isnan(stat) else tails.f_sf(stat, lags, d2)
    return _one(
        daily.sparkSession, lags=lags, n=n, statistic=stat, dof_denominator=d2, **_verdict(p, alpha)
    )


def spike_alert(
    daily: DataFrame, column: str, window: int = 7, factor: float = 2.0, order_by: str = "day"
) -> DataFrame:
    """Daily rows with ``baseline`` (mean of the rows before) and ``alert``.

    The baseline needs all of its ``window`` rows.
    """
    before = Window.orderBy(order_by).rowsBetween(-window, -1)
    value = finite(col(column))
    baseline = F.when(F.count(value).over(before) == window, F.avg(value).over(before))
    return daily.withColumn("baseline", baseline).withColumn(
        "alert", F.coalesce(value >= F.lit(factor) * F.col("baseline"), F.lit(False))
    )
