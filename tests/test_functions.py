"""Column expressions: the null rules and every band edge."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from caretide.functions import dates, measures, tails, text
from caretide.functions.columns import finite


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_keywords_hit_and_none(spark):
    got = column(
        spark,
        [
            "The flu outbreak has caused many hospitalizations this season.",
            "The weather is nice today.",
            "INFLUENZA",
            None,
            "",
        ],
        "string",
        text.extract_keywords,
    )
    assert got[0] == "flu, outbreak, hospitalization"
    assert got[1:] == ["none", "flu, influenza", "none", "none"]


def test_keyword_array(spark):
    assert column(spark, ["flu and rsv", "x"], "string", text.keyword_array) == [["flu", "rsv"], []]


def test_categories(spark):
    got = column(
        spark,
        [
            "New Flu Outbreak Detected Health officials report a surge in cases.",
            "New Vaccine Approved The FDA approved a new immunization today.",
            "Travel advisory",
            "respiratory season",
            "Picnic",
            None,
        ],
        "string",
        text.categorize,
    )
    assert got == ["Outbreak", "Vaccination", "Alert", "Respiratory Illness", "General Health", "General Health"]


def test_strip_takes_unicode_whitespace(spark):
    padded = ["  a b \t\n", "  ", None, "\x1cz\x85", "x "]
    assert column(spark, padded, "string", text.strip) == ["a b", "", None, "z", "x"]


def test_clean_post_text(spark):
    got = column(
        spark,
        ["See http://a.b/c?d=1 now! It's 50% off_it www.x.y", "½ été x—y", "a\n\n b"],
        "string",
        text.clean_post_text,
    )
    assert got == ["See now It's 50 off_it", "½ été x y", "a b"]


def test_clean_short_text(spark):
    got = column(
        spark, ["@bob_1 I'm #sick at https://t.co/x !", "# alone @"], "string", text.clean_short_text
    )
    assert got == ["I m sick at", "alone"]


def test_health_flag_is_false_for_null(spark):
    assert column(spark, ["My DOCTOR", "no", None], "string", text.is_health_related) == [True, False, False]


def test_truncate_counts_code_points(spark):
    assert column(spark, ["é😀abc"], "string", lambda c: text.truncate(c, 3)) == ["é😀a"]


def test_absolute_url(spark):
    got = column(spark, ["/a", "https://b", None], "string", lambda c: text.absolute_url(c, "https://h"))
    assert got == ["https://h/a", "https://b", None]


def test_parse_date_restores_leading_zero(spark):
    got = column(spark, ["01152021", "1152021", "13452021", "bad", None], "string", dates.parse_date)
    assert got == [dt.date(2021, 1, 15), dt.date(2021, 1, 15), None, None, None]


def test_parse_date_tries_formats_in_order(spark):
    got = column(
        spark, ["2021-02-03", "02032021"], "string", lambda c: dates.parse_date(c, ("yyyy-MM-dd", "MMddyyyy"))
    )
    assert got == [dt.date(2021, 2, 3)] * 2


def test_iso_timestamp_default(spark):
    got = column(
        spark,
        ["2024-01-02T03:04:05Z", None, "2024-01-02T03:04:05+02:00"],
        "string",
        lambda c: F.date_format(dates.parse_iso_timestamp(c, "2020-01-01 00:00:00"), "yyyy-MM-dd HH:mm"),
    )
    assert got == ["2024-01-02 03:04", "2020-01-01 00:00", "2024-01-02 01:04"]


def test_age_bands(spark):
    ages = [-1, 0, 17, 18, 44, 45, 64, 65, 119, 120, None]
    assert column(spark, ages, "int", measures.age_group) == [
        None, "0-17", "0-17", "18-44", "18-44", "45-64", "45-64", "65+", "65+", None, None,
    ]


def test_arrival_hour_and_band(spark):
    clocks = ["0", "0030", "559", "0600", "1759", "2359", "2400", "xx", None]
    hours = [0.0, 0.0, 5.0, 6.0, 17.0, 23.0, 24.0, None, None]
    assert column(spark, clocks, "string", dates.arrival_hour) == hours
    bands = column(spark, clocks, "string", lambda c: dates.time_of_day(dates.arrival_hour(c)))
    assert bands == ["Night"] * 3 + ["Morning", "Afternoon", "Evening", None, None, None]


def test_flags_of_null(spark):
    assert column(spark, [1, 2, 3, None], "int", measures.acuity_flag) == [1, 1, 0, 0]
    assert column(spark, [4, 5, 6, None], "int", measures.insured_flag) == [1, 0, 0, 1]


def test_sentiment_bands_differ_at_the_edges(spark):
    scores = [-1.0, -0.3, -0.29, 0.3, 0.31, 1.0, None]
    assert column(spark, scores, "double", measures.sentiment_label) == [
        "negative", "neutral", "neutral", "neutral", "positive", "positive", "neutral",
    ]
    assert column(spark, scores, "double", measures.sentiment_category) == [
        None, "Negative", "Neutral", "Neutral", "Positive", "Positive", None,
    ]


def test_pct_change_of_zero(spark):
    got = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0), (None, 1.0)], "a double, b double").select(
        measures.pct_change("a", "b")
    ).collect()
    assert [r[0] for r in got] == [0.0, 25.0, None]


def test_human_number_equals_binary_rounding(spark):
    numbers = [*range(0, 1_500_000, 50), 999_949, 999_950, 999_999, 1_150_000, 1_250_000, 1_350_000, -7, 5_000_000_000]

    def expected(n):
        return f"{n / 1e6:.1f}M" if n >= 1e6 else f"{n / 1e3:.1f}K" if n >= 1e3 else str(n)

    assert column(spark, numbers, "bigint", measures.human_number) == [expected(n) for n in numbers]


def test_temporal_features_of_null_date(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2020, 1, 1),), (None,)], "d date")
    rows = df.select(*[c.alias(n) for n, c in dates.temporal_features("d").items()]).collect()
    end, first, null = (r.asDict() for r in rows)
    assert (end["week_of_year"], end["is_month_end"], end["is_weekend"], end["quarter"]) == (52, 1, 1, 4)
    assert (first["days_since_epoch"], first["is_month_start"], first["day_of_week"]) == (0, 1, 2)
    assert null["year"] is None and null["days_since_epoch"] is None
    assert {null[k] for k in null if k.startswith("is_")} == {0}


def test_holidays_by_day(spark):
    df = spark.sql("select timestamp '2023-07-04 15:00:00' as d")
    assert df.select(dates.temporal_features("d")["is_holiday"]).first()[0] == 1


def test_cycle(spark):
    s, c = spark.range(1).select(*dates.cycle(F.lit(3), 12)).first()
    assert s == pytest.approx(1.0) and c == pytest.approx(0.0, abs=1e-12)


def test_finite(spark):
    assert column(spark, [1.0, math.nan, None], "double", finite) == [1.0, None, None]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (tails.t_two_sided(2.228138852, 10), 0.05),
        (tails.t_two_sided(12.706204736, 1), 0.05),
        (tails.t_two_sided(-2.228138852, 10), 0.05),
        (tails.f_sf(4.964602744, 1, 10), 0.05),
        (tails.f_sf(3.098391212, 3, 20), 0.05),
        (tails.chi2_sf(3.841458821, 1), 0.05),
        (tails.chi2_sf(18.307038053, 10), 0.05),
        (tails.chi2_sf(124.342113404, 100), 0.05),
        (tails.normal_sf(1.959963985), 0.025),
        (tails.normal_quantile(0.9), 1.281551566),
        (tails.beta_inc(2, 3, 0.5), 0.6875),
        (tails.gamma_sf(1, 2.0), math.exp(-2)),
    ],
)
def test_tails_against_tables(value, expected):
    assert value == pytest.approx(expected, abs=1e-8)
