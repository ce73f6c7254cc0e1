"""Hypothesis tests, rates and daily signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide.operators import hypothesis as hy
from checks.registry import duck_date, query, rounded, table, text_date, view, with_views
from checks.scalars import DUCK_DERIVED, derived

_T_IND = """a AS (SELECT count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem WHERE l_linestatus = 'F'),
  b AS (SELECT count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem WHERE l_linestatus = 'O'),
  p AS (SELECT a.n AS n1, b.n AS n2, a.m AS m1, b.m AS m2,
    ((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) AS pv FROM a, b)"""


@query(
    "ttest_ind",
    f"""WITH {_T_IND} SELECT round((m1 - m2) / sqrt(pv * (1.0 / n1 + 1.0 / n2)), 6) AS statistic,
    CAST(n1 + n2 - 2 AS BIGINT) AS dof, round((m1 - m2) / sqrt(pv), 6) AS effect_size FROM p""",
)
def ttest_ind(spark, sf):
    out = hy.ttest_ind(table(spark, sf, "lineitem"), "l_quantity", "l_linestatus", ("F", "O"))
    return rounded(out, "statistic", "effect_size").select("statistic", "dof", "effect_size")


@query(
    "ttest_paired",
    """SELECT round(avg(l_discount - l_tax) / (stddev_samp(l_discount - l_tax) / sqrt(count(*))), 4) AS statistic,
    count(*) - 1 AS dof, round((avg(l_discount) - avg(l_tax)) /
      sqrt((var_samp(l_discount) + var_samp(l_tax)) / 2), 6) AS effect_size FROM lineitem""",
)
def ttest_paired(spark, sf):
    out = hy.ttest_paired(table(spark, sf, "lineitem"), "l_discount", "l_tax")
    return rounded(rounded(out, "effect_size"), "statistic", digits=4).select("statistic", "dof", "effect_size")


@query("cohens_d", f"WITH {_T_IND} SELECT round((m1 - m2) / sqrt(pv), 6) AS effect_size FROM p")
def cohens_d(spark, sf):
    out = hy.cohens_d(table(spark, sf, "lineitem"), "l_quantity", "l_linestatus", ("F", "O"))
    return rounded(out, "effect_size")


def _duck_chi2(a: str, b: str, source: str) -> str:
    return f"""c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {source} GROUP BY 1, 2),
    ra AS (SELECT a, sum(n) AS na FROM c GROUP BY a), rb AS (SELECT b, sum(n) AS nb FROM c GROUP BY b),
    g AS (SELECT coalesce(n, 0)::DOUBLE AS o, na::DOUBLE * nb / (SELECT sum(n) FROM c) AS e
      FROM ra CROSS JOIN rb LEFT JOIN c USING (a, b)),
    dims AS (SELECT (SELECT count(*) FROM ra) AS ka, (SELECT count(*) FROM rb) AS kb, (SELECT sum(n) FROM c) AS total)"""


@query(
    "chi2_contingency",
    f"""WITH {_duck_chi2('l_returnflag', 'l_linestatus', 'lineitem')}
    SELECT round((SELECT sum((o - e) * (o - e) / e) FROM g), 4) AS statistic, CAST((ka - 1) * (kb - 1) AS BIGINT) AS dof FROM dims""",
)
def chi2_contingency(spark, sf):
    out = hy.chi2_contingency(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return rounded(out, "statistic", digits=4).select("statistic", "dof")


@query(
    "chi2_yates",
    f"""WITH {_duck_chi2('quality', 'toxic', 'labels')}
    SELECT round((SELECT sum(power(abs(o - e) - least(0.5, abs(o - e)), 2) / e) FROM g), 6) AS statistic,
      CAST((ka - 1) * (kb - 1) AS BIGINT) AS dof FROM dims""",
)
def chi2_yates(spark, sf):
    out = hy.chi2_contingency(table(spark, sf, "labels"), "quality", "toxic")
    return rounded(out, "statistic").select("statistic", "dof")


@query(
    "chi2_goodness",
    """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
    e AS (SELECT sum(n)::DOUBLE / count(*) AS e FROM c)
    SELECT round(sum((n - e) * (n - e) / e), 6) AS statistic, count(*) - 1 AS dof FROM c, e""",
)
def chi2_goodness(spark, sf):
    observed = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    kinds, total = observed.agg(F.count(F.lit(1)), F.sum("n")).first()
    expected = observed.select("event_type", F.lit(total / kinds).alias("n"))
    out = hy.chi2_goodness(observed, expected, "event_type")
    return rounded(out, "statistic").select("statistic", "dof")


@query(
    "anova_oneway",
    """WITH g AS (SELECT event_type, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1),
    t AS (SELECT avg(value) AS gm FROM events),
    s AS (SELECT sum(n * (m - gm) * (m - gm)) AS ssb, sum((n - 1) * v) AS ssw, count(*) AS k, sum(n) AS n FROM g, t)
    SELECT round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS statistic, CAST(k - 1 AS BIGINT) AS dof_between,
      CAST(n - k AS BIGINT) AS dof_within FROM s""",
)
def anova_oneway(spark, sf):
    out = hy.anova_oneway(table(spark, sf, "events"), "value", "event_type")
    return rounded(out, "statistic").select("statistic", "dof_between", "dof_within")


@query(
    "corr_pearson",
    "SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation, count(*) AS n FROM lineitem",
)
def corr_pearson(spark, sf):
    out = hy.corr_pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(out, "correlation").select("correlation", "n")


@query(
    "corr_spearman",
    """WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0::DOUBLE AS rx,
      rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0::DOUBLE AS ry FROM part)
    SELECT round(corr(rx, ry), 6) AS correlation, count(*) AS n FROM r""",
)
def corr_spearman(spark, sf):
    out = hy.corr_spearman(table(spark, sf, "part"), "p_size", "p_retailprice")
    return rounded(out, "correlation").select("correlation", "n")


@query(
    "corr_spearman_large",
    """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS rx,
      rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS ry FROM lineitem)
    SELECT round(corr(rx, ry), 6) AS correlation, count(*) AS n FROM r""",
)
def corr_spearman_large(spark, sf):
    out = hy.corr_spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(out, "correlation").select("correlation", "n")


@query(
    "corr_kendall",
    """WITH p AS (SELECT p_size AS x, p_retailprice AS y FROM part),
    s AS (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) / 2 AS s, count(*) FILTER (a.x <> b.x) / 2 AS dx,
      count(*) FILTER (a.y <> b.y) / 2 AS dy FROM p a, p b)
    SELECT round(s / sqrt(dx::DOUBLE * dy), 6) AS correlation, (SELECT count(*) FROM part) AS n FROM s""",
)
def corr_kendall(spark, sf):
    out = hy.corr_kendall(table(spark, sf, "part"), "p_size", "p_retailprice", small=100)
    return rounded(out, "correlation").select("correlation", "n")


@query("corr_kendall_large")
def corr_kendall_large(spark, sf):
    return hy.corr_kendall(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


@query(
    "normality",
    """WITH m AS (SELECT count(*) AS n, avg(l_extendedprice) AS a, stddev_pop(l_extendedprice) AS s FROM lineitem),
    k AS (SELECT avg(power((l_extendedprice - a) / s, 3)) AS g, avg(power((l_extendedprice - a) / s, 4)) - 3 AS h,
      any_value(n) AS n FROM lineitem, m)
    SELECT 'jarque-bera' AS method, round(n / 6.0::DOUBLE * (g * g + h * h / 4), 2) AS statistic FROM k""",
)
def normality(spark, sf):
    out = hy.normality(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(out, "statistic", digits=2).select("method", "statistic")


@query(
    "cramers_v",
    f"""WITH {_duck_chi2('l_returnflag', 'l_linestatus', 'lineitem')},
    x AS (SELECT sum((o - e) * (o - e) / e) AS s FROM g)
    SELECT round(s, 4) AS chi2, CAST(total AS BIGINT) AS n, round(sqrt(s / (total * least(ka - 1, kb - 1))), 6) AS cramers_v
    FROM x, dims""",
)
def cramers_v(spark, sf):
    out = hy.cramers_v(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return rounded(rounded(out, "cramers_v"), "chi2", digits=4)


_TWO = """t AS (SELECT count(*) FILTER (has_insurance = 0 AND high_acuity = 0) AS a,
    count(*) FILTER (has_insurance = 0 AND high_acuity = 1) AS b,
    count(*) FILTER (has_insurance = 1 AND high_acuity = 0) AS c,
    count(*) FILTER (has_insurance = 1 AND high_acuity = 1) AS d FROM e)"""


@query(
    "odds_ratio",
    with_views("v_visits")
    + f""", {DUCK_DERIVED}, {_TWO}, o AS (SELECT *, (a * d)::DOUBLE / (b * c) AS r,
      1.959963984540054 * sqrt(1.0::DOUBLE / a + 1.0::DOUBLE / b + 1.0::DOUBLE / c + 1.0::DOUBLE / d) AS w FROM t)
    SELECT round(r, 6) AS odds_ratio, round(r * exp(-w), 6) AS ci_lower, round(r * exp(w), 6) AS ci_upper, a, b, c, d FROM o""",
)
def odds_ratio(spark, sf):
    out = hy.odds_ratio(derived(spark, sf), F.col("has_insurance") == 0, F.col("high_acuity") == 0)
    return rounded(out, "odds_ratio", "ci_lower", "ci_upper")


@query(
    "rate_ratio",
    with_views("v_visits")
    + f""", {DUCK_DERIVED}, {_TWO} SELECT round(a::DOUBLE / (a + b), 6) AS rate_exposed,
      round(c::DOUBLE / (c + d), 6) AS rate_other, round((a::DOUBLE / (a + b)) / (c::DOUBLE / (c + d)), 6) AS rate_ratio FROM t""",
)
def rate_ratio(spark, sf):
    out = hy.rate_ratio(derived(spark, sf), F.col("has_insurance") == 0, F.col("high_acuity") == 0)
    return rounded(out, "rate_exposed", "rate_other", "rate_ratio")


_LAGS = ", ".join(f"lag(visits, {k}) OVER (ORDER BY ds) AS x{k}" for k in range(6))


@query(
    "cross_correlation",
    with_views("v_orders_daily")
    + f", w AS (SELECT y, {_LAGS} FROM v_orders_daily) "
    + " UNION ALL ".join(f"SELECT {k} AS lag, round(corr(x{k}, y), 6) AS r, count(x{k}) AS n FROM w" for k in range(6)),
)
def cross_correlation(spark, sf):
    out = hy.cross_correlation(view(spark, sf, "v_orders_daily"), "visits", "y", 5, "ds")
    return rounded(out, "r")


@query("granger")
def granger(spark, sf):
    return hy.granger(view(spark, sf, "v_orders_daily"), "visits", "y", 3, "ds")


_BEFORE = "OVER (ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"


@query(
    "spike_alert",
    with_views("v_orders_daily")
    + f""", b AS (SELECT ds, visits, CASE WHEN count(visits) {_BEFORE} = 7 THEN avg(visits) {_BEFORE} END AS base
      FROM v_orders_daily)
    SELECT {duck_date('ds')} AS ds, visits, round(base, 6) AS baseline, coalesce(visits >= 2 * base, false) AS alert FROM b""",
)
def spike_alert(spark, sf):
    out = hy.spike_alert(view(spark, sf, "v_orders_daily"), "visits", order_by="ds").drop("y")
    return rounded(out, "baseline").withColumn("ds", text_date("ds"))
