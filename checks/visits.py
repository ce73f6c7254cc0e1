"""Cleaning, quality, exploration and dashboard queries on visits and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide.operators import cleaning as cl
from caretide.operators import explore as ex
from caretide.operators import features as ft
from caretide.operators import quality as ql
from caretide.operators import schema as sc
from caretide.operators import sequence as sq
from caretide.operators.quantiles import approx_quantiles, grouped_quantiles, quantile_table
from caretide.plans.clean import clean_visits as clean_visits_plan
from caretide.plans.report import quality_report as quality_report_plan
from caretide.session import scratch_path
from caretide.sources.visits import read_visits as read_visits_file
from caretide.sources.visits import write_clean as write_clean_file
from checks.registry import duck_date, duck_strip, query, rounded, table, text_date, view, with_views
from checks.scalars import (
    DUCK_AGE_GROUP,
    DUCK_DERIVED,
    DUCK_HOUR,
    ROLLING,
    _duck_lags,
    _duck_rolling,
    derived,
    duck_time_of_day,
)

NUMBERS = ("AGE", "SEX", "WAITTIME", "LOS", "IMMEDR", "PAYTYPER", "LEFTBTRT", "FLATCOL")
TEXTS = ("VDATE", "ARRTIME", "DIAG1", "RFV1")
_VISIT_DATE = "CAST(try_strptime(VDATE, '%m%d%Y') AS DATE)"


# --- sources and sinks -----------------------------------------------------

_EXTRACT_TEXT = ", ".join(
    [f"CAST(round({c}, 6) AS DOUBLE) AS {c}" if c in ("WAITTIME", "LOS") else c for c in NUMBERS]
)


@query(
    "read_visits",
    with_views("v_visits") + f" SELECT VDATE, ARRTIME, RFV1, {_EXTRACT_TEXT} FROM v_visits",
)
def read_visits(spark, sf):
    path = scratch_path(spark, "extract")
    view(spark, sf, "v_visits").drop("visit_id", "visit_ts").write.option("header", True).csv(path)
    types = {"WAITTIME": "double", "LOS": "double", "FLATCOL": "int"}
    out = read_visits_file(spark, path, types).select("VDATE", "ARRTIME", "RFV1", *NUMBERS)
    return rounded(out, "WAITTIME", "LOS")


@query(
    "write_clean",
    with_views("v_visits")
    + f""", {DUCK_DERIVED} SELECT visit_id, age_group, high_acuity, {duck_date('visit_date')} AS visit_date FROM e""",
)
def write_clean(spark, sf):
    path = scratch_path(spark, "clean")
    write_clean_file(derived(spark, sf), path)
    stored = spark.read.parquet(path)
    return stored.select("visit_id", "age_group", "high_acuity", text_date("visit_date").alias("visit_date"))


# --- cleaning --------------------------------------------------------------


@query(
    "parse_date_drop_bad",
    with_views("v_visits")
    + f""" SELECT visit_id, {duck_date(_VISIT_DATE)} AS visit_date FROM v_visits
    WHERE {_VISIT_DATE} IS NOT NULL""",
)
def parse_date_drop_bad(spark, sf):
    out = cl.parse_date_drop_bad(view(spark, sf, "v_visits"), "VDATE", into="visit_date")
    return out.select("visit_id", text_date("visit_date").alias("visit_date"))


@query(
    "range_violations",
    with_views("v_visits")
    + """ SELECT 'AGE' AS "column", count(*) FILTER (AGE < 0 OR AGE > 120) AS violations FROM v_visits
    UNION ALL SELECT 'WAITTIME', count(*) FILTER (WAITTIME < 1 OR WAITTIME > 90) FROM v_visits""",
)
def range_violations(spark, sf):
    return cl.range_violations(view(spark, sf, "v_visits"), {"AGE": (0, 120), "WAITTIME": (1, 90)})


_FENCES = """b AS (SELECT quantile_cont(WAITTIME, 0.25) AS q1, quantile_cont(WAITTIME, 0.75) AS q3 FROM v_visits),
    f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b)"""


@query(
    "iqr_outliers",
    with_views("v_visits")
    + f", {_FENCES} SELECT visit_id, WAITTIME FROM v_visits, f WHERE WAITTIME < lo OR WAITTIME > hi",
)
def iqr_outliers(spark, sf):
    return cl.iqr_outliers(view(spark, sf, "v_visits"), "WAITTIME").select("visit_id", "WAITTIME")


@query(
    "iqr_outlier_summary",
    with_views("v_visits")
    + f""", {_FENCES} SELECT count(*) FILTER (WAITTIME < lo OR WAITTIME > hi) AS n_outliers,
    round(count(*) FILTER (WAITTIME < lo OR WAITTIME > hi) * 100.0::DOUBLE / count(*), 6) AS pct_outliers,
    round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound FROM v_visits, f""",
)
def iqr_outlier_summary(spark, sf):
    out = cl.iqr_outlier_summary(view(spark, sf, "v_visits"), "WAITTIME")
    return rounded(out, "pct_outliers", "lower_bound", "upper_bound")


def _duck_clip(c: str, source: str) -> str:
    """Clipped column; the bound comes from the one-row table ``source``."""
    return f"round(CASE WHEN {c} > {source}.{c} THEN {source}.{c} ELSE {c} END, 6)"


_WINSOR = ("AGE", "WAITTIME", "LOS", "IMMEDR", "LEFTBTRT", "FLATCOL")


@query(
    "winsorize_upper",
    with_views("v_visits")
    + ", b AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.99) AS b_{c}" for c in _WINSOR)
    + " FROM v_visits) SELECT visit_id, "
    + ", ".join(
        f"round(CAST(CASE WHEN {c} > b_{c} THEN b_{c} ELSE {c} END AS DOUBLE), 6) AS {c}" for c in _WINSOR
    )
    + " FROM v_visits, b",
)
def winsorize_upper(spark, sf):
    out = _as_double(cl.winsorize_upper(view(spark, sf, "v_visits"), columns=_WINSOR), _WINSOR)
    return rounded(out.select("visit_id", *_WINSOR), *_WINSOR)


def _as_double(df, names):
    """Integer columns keep their type where they can; SQL has them all as DOUBLE."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _duck_mode(c: str, source: str) -> str:
    return (
        f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        f" ORDER BY count(*) DESC, {c} LIMIT 1)"
    )


def _duck_impute(source: str) -> str:
    numbers = [
        f"CAST(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {source})) AS DOUBLE) AS {c}"
        for c in NUMBERS
    ]
    texts = [f"coalesce({c}, {_duck_mode(c, source)}) AS {c}" for c in TEXTS]
    return ", ".join(numbers + texts)


@query(
    "impute",
    with_views("v_visits")
    + f" SELECT visit_id, CAST(visit_id + 9007199254740993 AS BIGINT) AS wide_id, {_duck_impute('v_visits')} FROM v_visits",
)
def impute(spark, sf):
    visits = view(spark, sf, "v_visits")
    wide = (F.col("visit_id") + 9007199254740993).alias("wide_id")
    out = cl.impute(visits.select("visit_id", wide, *NUMBERS, *TEXTS))
    return _as_double(out, NUMBERS)


@query(
    "drop_exact_duplicates",
    with_views("v_extract")
    + " SELECT DISTINCT VDATE, AGE, SEX, ARRTIME, WAITTIME, LOS, IMMEDR, PAYTYPER, DIAG1, RFV1, LEFTBTRT, FLATCOL FROM v_extract",
)
def drop_exact_duplicates(spark, sf):
    extract = view(spark, sf, "v_extract")
    return cl.drop_exact_duplicates(extract)


@query(
    "strip_diagnosis",
    with_views("v_visits") + f" SELECT visit_id, {duck_strip('DIAG1')} AS DIAG1 FROM v_visits",
)
def strip_diagnosis(spark, sf):
    return cl.strip_diagnosis(view(spark, sf, "v_visits")).select("visit_id", "DIAG1")


_CLEAN_NUMBERS = (
    *NUMBERS, "arrival_hour", "high_acuity", "has_insurance", "day_of_week", "is_weekend", "month",
)
_CLEAN_SQL = (
    with_views("v_extract")
    + f""", i AS (SELECT DISTINCT {_duck_impute('v_extract')} FROM v_extract),
    d AS (SELECT *, {_VISIT_DATE} AS visit_date, {DUCK_AGE_GROUP} AS age_group,
        {DUCK_HOUR} AS arrival_hour, CAST(IMMEDR IN (1,2) AS INT) AS high_acuity,
        CASE WHEN PAYTYPER IN (5,6) THEN 0 ELSE 1 END AS has_insurance FROM i),
    e AS (SELECT *, isodow(visit_date) - 1 AS day_of_week,
        CAST(coalesce(isodow(visit_date) >= 6, false) AS INT) AS is_weekend,
        month(visit_date) AS month FROM d),
    b AS (SELECT """
    + ", ".join(f"quantile_cont({c}, 0.99) AS b_{c}" for c in _CLEAN_NUMBERS)
    + f""" FROM e)
    SELECT VDATE, ARRTIME, RFV1, {duck_strip('DIAG1')} AS DIAG1, age_group,
      {duck_date('visit_date')} AS visit_date, {duck_time_of_day('arrival_hour')} AS time_of_day, """
    + ", ".join(
        f"round(CAST(CASE WHEN {c} > b_{c} THEN b_{c} ELSE {c} END AS DOUBLE), 6) AS {c}"
        for c in _CLEAN_NUMBERS
    )
    + " FROM e, b"
)


@query("clean_visits", _CLEAN_SQL)
def clean_visits(spark, sf):
    out = _as_double(clean_visits_plan(view(spark, sf, "v_extract")), _CLEAN_NUMBERS)
    return rounded(out, *_CLEAN_NUMBERS).withColumn("visit_date", text_date("visit_date"))


# --- quality ---------------------------------------------------------------

_VISIT_COLUMNS = ("visit_id", "visit_ts", *TEXTS, *NUMBERS)
_MISSING = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing,
    round(count(*) FILTER ({c} IS NULL)::DOUBLE / count(*), 6) AS ratio,
    count(*) FILTER ({c} IS NULL)::DOUBLE / count(*) > 0.05 AS high_missing FROM v_visits"""
    for c in _VISIT_COLUMNS
)


@query(
    "missing_report",
    with_views("v_visits")
    + f""", m AS ({_MISSING}) SELECT * FROM m
    UNION ALL SELECT '__total__', CAST(sum(missing) AS BIGINT), NULL, false FROM m""",
)
def missing_report(spark, sf):
    return rounded(ql.missing_report(view(spark, sf, "v_visits"), 0.05), "ratio")


@query(
    "duplicate_report",
    with_views("v_extract")
    + """, g AS (SELECT count(*) AS n FROM v_extract GROUP BY ALL, VDATE, AGE, SEX, ARRTIME, WAITTIME, LOS,
      IMMEDR, PAYTYPER, DIAG1, RFV1, LEFTBTRT, FLATCOL),
    s AS (SELECT count(*) AS n FROM v_extract GROUP BY VDATE, AGE)
    SELECT 'all' AS checked, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
      round(sum(n - 1)::DOUBLE / sum(n), 6) AS duplicate_ratio FROM g
    UNION ALL SELECT 'VDATE, AGE', CAST(sum(n) AS BIGINT), CAST(sum(n - 1) AS BIGINT),
      round(sum(n - 1)::DOUBLE / sum(n), 6) FROM s""".replace("GROUP BY ALL, ", "GROUP BY "),
)
def duplicate_report(spark, sf):
    extract = view(spark, sf, "v_extract")
    whole = ql.duplicate_report(extract).withColumn("checked", F.lit("all"))
    part = ql.duplicate_report(extract, ["VDATE", "AGE"]).withColumn("checked", F.lit("VDATE, AGE"))
    return rounded(whole.unionByName(part), "duplicate_ratio")


def _duck_numeric(c: str, source: str, violations: tuple | None = None) -> str:
    fence = f"""(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
        quantile_cont({c}, 0.75) AS q3 FROM {source})"""
    lo, hi = "(q1 - 1.5 * (q3 - q1))", "(q3 + 1.5 * (q3 - q1))"
    metrics = {
        "lower_bound": f"any_value({lo})",
        "upper_bound": f"any_value({hi})",
        "outlier_count": f"count(*) FILTER ({c} < {lo} OR {c} > {hi})",
        "outlier_ratio": f"count(*) FILTER ({c} < {lo} OR {c} > {hi})::DOUBLE / count(*)",
        "min": f"min({c})", "max": f"max({c})", "mean": f"avg({c})", "median": "any_value(q2)",
        "std": f"stddev_samp({c})",
    }
    if violations:
        metrics["range_violations"] = f"count(*) FILTER ({c} < {violations[0]} OR {c} > {violations[1]})"
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value
        FROM {source}, {fence} fence"""
        for m, e in metrics.items()
    )


_LINE_NUMBERS = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "numeric_report",
    with_views("v_visits")
    + " "
    + " UNION ALL ".join(
        [_duck_numeric("AGE", "v_visits", (0, 120)), _duck_numeric("WAITTIME", "v_visits"),
         _duck_numeric("FLATCOL", "v_visits"), *[_duck_numeric(c, "lineitem") for c in _LINE_NUMBERS]]
    ),
)
def numeric_report(spark, sf):
    visits = ql.numeric_report(
        view(spark, sf, "v_visits").select("AGE", "WAITTIME", "FLATCOL"), {"AGE": (0, 120)}
    )
    lines = ql.numeric_report(table(spark, sf, "lineitem").select(*_LINE_NUMBERS))
    return rounded(visits.unionByName(lines), "value")


@query(
    "categorical_report",
    with_views("v_visits")
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique, count(*) FILTER ({c} IS NULL) AS null_count,
        CASE WHEN count(DISTINCT {c}) < 2 THEN 'few values'
             WHEN count(DISTINCT {c}) > 100 THEN 'high cardinality' END AS warning FROM v_visits"""
        for c in TEXTS
    ),
)
def categorical_report(spark, sf):
    return ql.categorical_report(view(spark, sf, "v_visits"))


@query(
    "top_k_values",
    with_views("v_visits")
    + ", u AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM v_visits" for c in TEXTS)
    + """), c AS (SELECT "column", value, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY ALL)
    SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c) WHERE rank <= 5""",
)
def top_k_values(spark, sf):
    return ql.categorical_top(view(spark, sf, "v_visits"))


@query(
    "date_report",
    with_views("v_visits")
    + f""", d AS (SELECT {_VISIT_DATE} AS v, CAST(visit_ts AS DATE) AS w FROM v_visits)
    SELECT 'VDATE' AS "column", count(*) FILTER (v IS NULL) AS null_count, {duck_date('min(v)')} AS min_date,
      {duck_date('max(v)')} AS max_date, CAST(date_diff('day', min(v), max(v)) AS INT) AS range_days FROM d
    UNION ALL SELECT 'visit_ts', count(*) FILTER (w IS NULL), {duck_date('min(w)')}, {duck_date('max(w)')},
      CAST(date_diff('day', min(w), max(w)) AS INT) FROM d""",
)
def date_report(spark, sf):
    out = ql.date_report(view(spark, sf, "v_visits"), ["VDATE", "visit_ts", "absent"])
    return out.withColumns({c: text_date(c) for c in ("min_date", "max_date")})


@query(
    "dtype_report",
    """SELECT 'bigint' AS data_type, 3 AS n_columns, 'l_orderkey, l_partkey, l_suppkey' AS columns
    FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'int', 1, 'l_linenumber' FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'double', 4, 'l_quantity, l_extendedprice, l_discount, l_tax' FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'string', 2, 'l_returnflag, l_linestatus' FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'timestamp_ntz', 1, 'l_shipdate' FROM lineitem HAVING count(*) > 0""",
)
def dtype_report(spark, sf):
    return ql.dtype_report(table(spark, sf, "lineitem"))


@query("quality_report")
def quality_report(spark, sf):
    visits = view(spark, sf, "v_visits").drop("visit_id")
    return quality_report_plan(visits, {"AGE": (0, 120)}, ["VDATE"])


@query(
    "require_columns",
    with_views("v_posts")
    + """ SELECT 'date' AS "column", true AS present, count(*) FILTER (date IS NULL) AS null_count,
      count(*) AS row_count, false AS valid FROM v_posts
    UNION ALL SELECT 'text', true, count(*) FILTER (text IS NULL), count(*), false FROM v_posts
    UNION ALL SELECT 'absent', false, NULL, count(*), false FROM v_posts
    UNION ALL SELECT 'title', true, count(*) FILTER (title IS NULL), count(*), true FROM v_posts""",
)
def require_columns(spark, sf):
    posts = view(spark, sf, "v_posts")
    bad = sc.require_columns(posts, ["date", "text", "absent"])
    return bad.unionByName(sc.require_columns(posts, ["title"]))


# --- exploration -----------------------------------------------------------

_PROBS = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)


@query(
    "quantiles",
    with_views("v_visits")
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {p}::DOUBLE AS p, round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 4) AS value
        FROM {t}"""
        for c, t in (("AGE", "v_visits"), ("WAITTIME", "v_visits"), ("l_extendedprice", "lineitem"),
                     ("l_quantity", "lineitem"))
        for p in _PROBS
    ),
)
def quantiles(spark, sf):
    visits = quantile_table(view(spark, sf, "v_visits"), ["AGE", "WAITTIME"], _PROBS)
    lines = quantile_table(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], _PROBS)
    return rounded(visits.unionByName(lines), "value", digits=4)


@query(
    "quantiles_by_group",
    " UNION ALL ".join(
        f"""SELECT '{g}' AS grouped_by, CAST({g} AS VARCHAR) AS part, {p}::DOUBLE AS p,
          round(CAST(quantile_cont(CAST({c} AS DOUBLE), {p}) AS DOUBLE), 4) AS value
        FROM {t} GROUP BY {g}"""
        for t, g, c in (("lineitem", "l_returnflag", "l_extendedprice"), ("orders", "o_custkey", "o_totalprice"))
        for p in _PROBS
    ),
)
def quantiles_by_group(spark, sf):
    """A few groups with most rows, and very many small ones."""
    got = []
    for t, g, c in (("lineitem", "l_returnflag", "l_extendedprice"), ("orders", "o_custkey", "o_totalprice")):
        found = grouped_quantiles(table(spark, sf, t), [g], c, _PROBS)
        got.append(found.select(F.lit(g).alias("grouped_by"), F.col(g).cast("string").alias("part"), "p", "value"))
    return rounded(got[0].unionByName(got[1]), "value", digits=4)


@query(
    "quantiles_approx",
    " UNION ALL ".join(f"SELECT {p}::DOUBLE AS p, count(*) AS n, true AS within FROM lineitem" for p in _PROBS),
)
def quantiles_approx(spark, sf):
    """Is the rank of every sketch quantile as near as promised (n / 10000)?"""
    lines = table(spark, sf, "lineitem").select("l_extendedprice")
    got = approx_quantiles(lines, {"l_extendedprice": _PROBS})["l_extendedprice"]
    price, n = F.col("l_extendedprice"), F.count(F.lit(1))
    cells = []
    for p in _PROBS:
        low, high = F.count_if(price < got[p]), F.count_if(price <= got[p])
        near = (low <= n * p + n / 10_000 + 1) & (high >= n * p - n / 10_000 - 1)
        cells.append(F.struct(F.lit(p).alias("p"), n.alias("n"), near.alias("within")))
    return lines.agg(F.array(*cells).alias("c")).select(F.inline("c"))


_AGE_BANDS = with_views("v_visits") + f", {DUCK_DERIVED} "


@query(
    "value_counts",
    _AGE_BANDS + "SELECT age_group AS value, count(*) AS n FROM e WHERE age_group IS NOT NULL GROUP BY 1",
)
def value_counts(spark, sf):
    return ex.value_counts(derived(spark, sf), "age_group")


@query(
    "value_share",
    _AGE_BANDS
    + """SELECT high_acuity AS value, count(*) AS n,
    round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM e), 6) AS pct FROM e GROUP BY 1""",
)
def value_share(spark, sf):
    return rounded(ex.value_share(derived(spark, sf), "high_acuity"), "pct")


@query(
    "day_of_week_counts",
    _AGE_BANDS
    + """SELECT CAST(k AS INT) AS day_of_week, count(e.visit_id) AS n FROM range(7) t(k)
    LEFT JOIN e ON e.day_of_week = k GROUP BY 1""",
)
def day_of_week_counts(spark, sf):
    return ex.day_of_week_counts(derived(spark, sf))


def _duck_summary(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
    round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS p25, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS p50,
    round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS p75, round(CAST(max({c}) AS DOUBLE), 4) AS max,
    count(*) FILTER ({c} IS NULL) AS missing,
    round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 4) AS missing_pct"""


_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max", "missing_pct")


@query(
    "summary_stats",
    with_views("v_visits")
    + " "
    + " UNION ALL ".join(
        [_duck_summary(c) + " FROM lineitem" for c in _LINE_NUMBERS]
        + [_duck_summary(c) + " FROM v_visits" for c in ("AGE", "WAITTIME")]
    ),
)
def summary_stats(spark, sf):
    lines = ex.summary_stats(table(spark, sf, "lineitem"), _LINE_NUMBERS)
    visits = ex.summary_stats(view(spark, sf, "v_visits"), ["AGE", "WAITTIME"])
    return rounded(lines.unionByName(visits), *_STATS, digits=4)


def _duck_distribution(c: str, source: str, flat: bool = False) -> str:
    metrics = {
        "mean": f"avg({c})", "median": f"quantile_cont({c}, 0.5)", "std": f"stddev_samp({c})",
        "skewness": "max(0.0)" if flat else f"skewness({c})",
        "kurtosis": "max(0.0)" if flat else f"kurtosis({c})",
        "min": f"min({c})", "max": f"max({c})",
    }
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{m}' AS metric, round(CAST({e} AS DOUBLE), 4) AS value FROM {source}"""
        for m, e in metrics.items()
    )


@query(
    "distribution_stats",
    with_views("v_visits")
    + " "
    + " UNION ALL ".join(
        [_duck_distribution(c, "lineitem") for c in _LINE_NUMBERS]
        + [_duck_distribution("WAITTIME", "v_visits"), _duck_distribution("FLATCOL", "v_visits", True)]
    ),
)
def distribution_stats(spark, sf):
    lines = ex.distribution_stats(table(spark, sf, "lineitem"), _LINE_NUMBERS)
    visits = ex.distribution_stats(view(spark, sf, "v_visits"), ["WAITTIME", "FLATCOL", "absent"])
    return rounded(lines.unionByName(visits), "value", digits=4)


def _duck_pairs(names, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS correlation FROM {source}"
        for i, a in enumerate(names)
        for b in names[i + 1 :]
    )


@query(
    "strong_correlations",
    f"""{with_views("v_visits")}, c AS ({_duck_pairs(_LINE_NUMBERS, "lineitem")}
      UNION ALL {_duck_pairs(("AGE", "WAITTIME", "LOS", "IMMEDR"), "v_visits")})
    SELECT * FROM c WHERE abs(correlation) > 0.001""",
)
def strong_correlations(spark, sf):
    lines = ex.strong_correlations(table(spark, sf, "lineitem"), 0.001, _LINE_NUMBERS)
    names = ["AGE", "WAITTIME", "LOS", "IMMEDR", "FLATCOL"]
    visits = ex.strong_correlations(view(spark, sf, "v_visits"), 0.001, names)
    return rounded(lines.unionByName(visits), "correlation")


_WIDE = [f"{c}_{k}" for k in range(9) for c in _LINE_NUMBERS]


@query(
    "correlations_wide",
    "WITH w AS (SELECT "
    + ", ".join(f"{c} * {k + 1} + l_partkey * {k} AS {c}_{k}" for k in range(9) for c in _LINE_NUMBERS)
    + " FROM lineitem), c AS (" + _duck_pairs(_WIDE, "w") + ") SELECT * FROM c WHERE abs(correlation) > 0.3",
)
def correlations_wide(spark, sf):
    """45 columns mixed from the numbers of a line: the one-scan path."""
    lines = table(spark, sf, "lineitem").select(
        *[
            (F.col(c) * (k + 1) + F.col("l_partkey") * k).alias(f"{c}_{k}")
            for k in range(9)
            for c in _LINE_NUMBERS
        ]
    )
    return rounded(ex.strong_correlations(lines, 0.3), "correlation")


# Large values beside gaps, infinities, a constant and a column that is constant where the others are present.
_GAPS = (
    "SELECT CAST(CASE WHEN l_orderkey % 7 = 0 THEN 1e7 + l_orderkey ELSE l_quantity END AS DOUBLE) AS large, "
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity * l_quantity END AS squares, "
    "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS price, "
    "CASE WHEN l_orderkey = 1 THEN {inf} ELSE CAST(l_tax AS DOUBLE) END AS endless, "
    "3 AS fixed, CASE WHEN l_orderkey % 7 = 0 THEN 5.0 ELSE 0.1 END AS steps FROM {lines}"
)
_GAP_NAMES = ("large", "squares", "price", "endless", "fixed", "steps")


@query(
    "correlations_gaps",
    f"""WITH g AS ({_GAPS.format(inf="CAST('inf' AS DOUBLE)", lines="lineitem")}),
    pairs AS ({" UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL AND NOT (isinf({a}) OR isinf({b}))) AS n, "
        f"count({a} + {b}) AS m, covar_pop({a}, {b}) FILTER (isfinite({a} + {b})) AS cov, "
        f"stddev_pop({a}) FILTER (isfinite({a} + {b})) AS sa, stddev_pop({b}) FILTER (isfinite({a} + {b})) AS sb, "
        f"min({a}) FILTER ({b} IS NOT NULL) < max({a}) FILTER ({b} IS NOT NULL) AND min({b}) FILTER ({a} IS NOT NULL) < max({b}) FILTER ({a} IS NOT NULL) AS varies FROM g"
        for i, a in enumerate(_GAP_NAMES) for b in _GAP_NAMES[i + 1:])})
    SELECT var1, var2, CASE WHEN varies AND n = m THEN round(cov / (sa * sb), 6) END AS correlation FROM pairs""",
)
def correlations_gaps(spark, sf):
    lines = spark.sql(_GAPS.format(inf="double('Infinity')", lines="{lines}"), lines=table(spark, sf, "lineitem"))
    return rounded(ex.correlations(lines, _GAP_NAMES), "correlation")


@query(
    "top_k",
    "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20",
)
def top_k(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return ex.top_k(part, "p_retailprice", 20, "p_partkey")


@query(
    "new_columns",
    with_views("v_visits")
    + """ SELECT c AS new_column FROM (SELECT unnest(['visit_date','age_group','arrival_hour','time_of_day',
    'high_acuity','has_insurance','day_of_week','is_weekend','month']) AS c) WHERE (SELECT count(*) FROM v_visits) > 0""",
)
def new_columns(spark, sf):
    names = sc.new_columns(view(spark, sf, "v_visits"), derived(spark, sf))
    return spark.createDataFrame([(n,) for n in names], "new_column string")


# --- features --------------------------------------------------------------


def _duck_group_stats(g: str, c: str) -> str:
    return f"""(SELECT {g} AS k_{g}, round(avg({c}), 6) AS {g}_mean, round(stddev_samp({c}), 6) AS {g}_std,
    count({c}) AS {g}_count, CAST(min({c}) AS DOUBLE) AS {g}_min, CAST(max({c}) AS DOUBLE) AS {g}_max
    FROM e WHERE {g} IS NOT NULL GROUP BY {g})"""


_GROUP_STATS = [f"{g}_{s}" for g in ("age_group", "RFV1") for s in ("mean", "std", "count", "min", "max")]


@query(
    "group_stats_join",
    _AGE_BANDS
    + f"""SELECT visit_id, {', '.join(_GROUP_STATS)} FROM e
    LEFT JOIN {_duck_group_stats('age_group', 'WAITTIME')} a ON e.age_group = a.k_age_group
    LEFT JOIN {_duck_group_stats('RFV1', 'WAITTIME')} b ON e.RFV1 = b.k_RFV1""",
)
def group_stats_join(spark, sf):
    out = ft.group_stats_join(derived(spark, sf), ["age_group", "RFV1"], "WAITTIME")
    names = [n for n in _GROUP_STATS if n.endswith(("_mean", "_std"))]
    return rounded(out, *names).select("visit_id", *_GROUP_STATS)


_BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"


@query("lagged_features", f"SELECT event_id, {_duck_lags('value', _BY_USER)} FROM events")
def lagged_features(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    out = sq.lagged_features(events, ["value"], ["ts", "event_id"], ["user_id"])
    return out.drop("ts", "user_id", "value")


_VALUE_ROLLING = [f"value{s}" for s in ROLLING]


@query("rolling_features", f"SELECT event_id, {_duck_rolling('value', _BY_USER)} FROM events")
def rolling_features(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    out = sq.rolling_features(events, ["value"], ["ts", "event_id"], ["user_id"])
    return rounded(out, *_VALUE_ROLLING).select("event_id", *_VALUE_ROLLING)


@query(
    "lag_rolling_whole_table",
    f"""SELECT event_id, {_duck_lags('value', 'ORDER BY ts, event_id')},
    {_duck_rolling('value', 'ORDER BY ts, event_id')} FROM events""",
)
def lag_rolling_whole_table(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    out = sq.lag_and_rolling(events, ["value"], ["ts", "event_id"])
    return rounded(out, *_VALUE_ROLLING).drop("ts", "value")


@query(
    "lag_rolling_split_keys",
    f"""SELECT event_id, {_duck_lags('value', _BY_USER)}, {_duck_rolling('value', _BY_USER)} FROM events""",
)
def lag_rolling_split_keys(spark, sf):
    """The plan for keys too large for one task, forced by a low bound."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    out = sq.lag_and_rolling(events, ["value"], ["ts", "event_id"], ["user_id"], rows_per_task=10)
    return rounded(out, *_VALUE_ROLLING).drop("ts", "user_id", "value")


@query(
    "lag_rolling_orders_daily",
    with_views("v_orders_daily")
    + f""" SELECT {duck_date('ds')} AS ds, {_duck_lags('y', 'ORDER BY ds')},
    {_duck_rolling('y', 'ORDER BY ds')} FROM v_orders_daily""",
)
def lag_rolling_orders_daily(spark, sf):
    out = sq.lag_and_rolling(view(spark, sf, "v_orders_daily"), ["y"], ["ds"])
    names = [f"y{s}" for s in ROLLING]
    return rounded(out, *names).drop("visits", "y").withColumn("ds", text_date("ds"))


# --- dashboards ------------------------------------------------------------


@query(
    "hour_weekday_heatmap",
    _AGE_BANDS
    + """SELECT arrival_hour, day_of_week, count(*) AS visits, round(avg(high_acuity), 6) AS high_acuity_share
    FROM e WHERE arrival_hour IS NOT NULL AND day_of_week IS NOT NULL GROUP BY 1, 2""",
)
def hour_weekday_heatmap(spark, sf):
    return rounded(ex.hour_weekday_heatmap(derived(spark, sf)), "high_acuity_share")


@query(
    "heatmap_grid",
    _AGE_BANDS
    + "SELECT arrival_hour, "
    + ", ".join(f"count(*) FILTER (day_of_week = {d}) AS d{d}" for d in range(7))
    + " FROM e WHERE arrival_hour IS NOT NULL AND day_of_week IS NOT NULL GROUP BY 1",
)
def heatmap_grid(spark, sf):
    return ex.heatmap_grid(derived(spark, sf))


@query(
    "kpi_panel",
    _AGE_BANDS
    + f""", p AS (SELECT visit_date AS day, count(*) AS visits, sum(high_acuity) AS acute FROM e
      WHERE visit_date IS NOT NULL GROUP BY 1)
    SELECT {duck_date('day')} AS day, visits,
      round(avg(visits) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS trailing_mean,
      {duck_date("CAST(date_trunc('week', day) AS DATE)")} AS week,
      round(sum(acute) OVER (PARTITION BY date_trunc('week', day)) * 100.0::DOUBLE
        / sum(visits) OVER (PARTITION BY date_trunc('week', day)), 6) AS high_acuity_pct_week FROM p""",
)
def kpi_panel(spark, sf):
    out = ex.kpi_panel(derived(spark, sf))
    out = rounded(out, "trailing_mean", "high_acuity_pct_week")
    return out.withColumns({c: text_date(c) for c in ("day", "week")})


@query(
    "demographic_breakdown",
    _AGE_BANDS
    + """SELECT age_group, has_insurance, CAST(grouping(age_group) * 2 + grouping(has_insurance) AS BIGINT) AS level,
    count(*) AS visits FROM e GROUP BY CUBE (age_group, has_insurance)""",
)
def demographic_breakdown(spark, sf):
    return ex.demographic_breakdown(derived(spark, sf))


@query(
    "peak_uplift",
    _AGE_BANDS
    + """, p AS (SELECT visit_date, count(*) AS n, count(*) FILTER (arrival_hour BETWEEN 18 AND 20) AS h FROM e
      WHERE visit_date IS NOT NULL AND arrival_hour IS NOT NULL GROUP BY 1),
    s AS (SELECT sum(n)::DOUBLE / (count(*) * 24) AS base, CAST(sum(h) FILTER (isodow(visit_date) = 1) AS BIGINT) AS w,
      count(*) FILTER (isodow(visit_date) = 1) AS d FROM p)
    SELECT w AS window_visits, round(w::DOUBLE / (d * 3), 6) AS window_rate, round(base, 6) AS base_rate,
      round((w::DOUBLE / (d * 3) / base - 1) * 100, 6) AS uplift_pct FROM s""",
)
def peak_uplift(spark, sf):
    return rounded(ex.peak_uplift(derived(spark, sf)), "window_rate", "base_rate", "uplift_pct")
