"""HTML sources, feed shaping, daily tables and sentiment."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caretide.operators import daily as dy
from caretide.operators import feeds as fd
from caretide.operators import sentiment as sn
from caretide.plans.enrich import enrich_visits
from caretide.session import broadcast_if_small, scratch_path
from caretide.sources import feeds as src
from caretide.sources import html
from caretide.sources.visits import read_visits, write_clean
from checks.catalog import QUERIES

DAY = dt.datetime(2024, 1, 1)


def _articles(spark, pages, **how):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return [r["content"] for r in html.extract_article(df, **how).orderBy("i").collect()]


def test_article_selectors_in_order(spark):
    got = _articles(
        spark,
        [
            "<article>second</article><div class='a syndicate'>first</div>",
            "<article>b</article><div class=content> a <i>c</i>\n d </div>",
            "<div class='col-md-12'>x</div><article>y</article>",
            "<div class='col-md-12'>x&amp;y<script>no</script><style>no</style><!-- no --></div>",
            "<div class='syndicated'>no</div>",
            "",
            None,
            "<article>open <b>never closed",
            "<div class='content'>one<div>two</div>three</div>after",
            "<article>a < b & c</article>",
        ],
    )
    assert got == [
        "first", "a c d", "y", "x&y", html.NOT_FOUND, html.NOT_FOUND, html.FAILED,
        "open never closed", "one two three", "a < b & c",
    ]


def test_article_is_cut_after_collapsing(spark):
    assert _articles(spark, ["<article>" + "ab \n " * 3000 + "</article>"])[0] == ("ab " * 3000)[:5000]


def _card(title="<h3> A <b>B</b> </h3>", link="<a href='/x'>l</a>", time=""):
    return f"<div class='card card-body'>{time}{title}{link}</div>"


def test_listing_cards(spark):
    page = "".join(
        [
            _card(time="<time datetime='2024-02-03T04:05:06Z'>t</time>"),
            _card(title=""),
            _card(link="<a name='n'>n</a>"),
            _card(link="<a name='n'>n</a><a href='https://o/y'>l</a>"),
            _card(time="<time>no attribute</time>"),
            _card(time="<time datetime='soon'>t</time>"),
            "<div class='card'>" + "<h3>no</h3><a href='/z'>z</a></div>",
        ]
    )
    df = spark.createDataFrame([("u", page), ("v", None), ("w", "<p>none</p>")], "url string, html string")
    rows = html.extract_listing(df, "2020-01-01 00:00:00", "https://h").orderBy("position").collect()
    got = [(r["position"], r["title"], r["url"], r["date"].isoformat(" ")) for r in rows]
    assert got == [
        (1, "AB", "https://h/x", "2024-02-03 04:05:06"),
        (4, "AB", "https://o/y", "2020-01-01 00:00:00"),
        (5, "AB", "https://h/x", "2020-01-01 00:00:00"),
    ]


def test_listing_limit_counts_skipped_cards(spark):
    page = _card(title="") + _card() * 150
    df = spark.createDataFrame([("u", page)], "url string, html string")
    assert html.extract_listing(df, "2020-01-01", "https://h").count() == 99


def test_listing_hands_back_bounded_pieces():
    pages = [(f"u{i}", _card() * 30) for i in range(500)] + [("none", None), ("long", _card(title="<h3>" + "t" * 3_000_000 + "</h3>") * 4)]
    batch = pa.RecordBatch.from_arrays([pa.array([u for u, _ in pages]), pa.array([p for _, p in pages])], ["page_url", "html"])
    pieces = list(html._listed(iter([batch]), 20))
    assert [p.num_rows for p in pieces] == [4096, 4096, 1810, 2]
    whole = pa.Table.from_batches(pieces)
    want = [(f"u{i}", k) for i in range(500) for k in range(1, 21)] + [("long", k) for k in range(1, 5)]
    assert list(zip(whole.column("page_url").to_pylist(), whole.column("position").to_pylist(), strict=True)) == want
    assert list(html._listed(iter([batch.slice(500, 1)]), 20)) == []


def test_news_joins_article_pages(spark):
    listing = spark.createDataFrame([("u", _card() + _card(link="<a href='/gone'>l</a>"))], "url string, html string")
    pages = spark.createDataFrame([("https://h/x", "<article>flu outbreak</article>")], "url string, html string")
    rows = src.shape_news(listing, pages, "2024-01-01 00:00:00", "https://h", "NEWS").orderBy("url").collect()
    assert [(r["content"], r["keywords"], r["category"]) for r in rows] == [
        (html.FAILED, "none", "General Health"),
        ("flu outbreak", "flu, outbreak", "Outbreak"),
    ]
    assert rows[0]["source"] == "NEWS"


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [("good", 0.8, 0.6), ("bad", -0.6, 0.4), ("sick", -0.9, 1.0)]
    return spark.createDataFrame(rows, "term string, polarity double, subjectivity double")


def test_sentiment(spark, lexicon):
    rows = [(1, "Good, good day!", 9.0), (2, "bad"), (3, "none here"), (4, None), (5, "good-bad"), (6, "goodness")]
    df = spark.createDataFrame([(r[0], r[1], 9.0) for r in rows], "id int, t string, sentiment_polarity double")
    out = sn.score_sentiment(df, "t", "id", lexicon)
    got = {r["id"]: (r["sentiment_polarity"], r["sentiment_subjectivity"], r["sentiment_label"]) for r in out.collect()}
    assert got[1] == (0.8, 0.6, "positive") and got[2] == (-0.6, 0.4, "negative")
    assert got[3] == got[4] == got[6] == (0.0, 0.0, "neutral") and got[5][0] == 0.1


def test_sentiment_belongs_to_the_text(spark, lexicon):
    """Rows that share an id or have none keep the score of their own text."""
    term = lexicon.filter("polarity > 0").first()["term"]
    df = spark.createDataFrame([(1, term), (1, "nothing"), (None, term), (2, None)], "id int, t string")
    got = [(r["id"], r["t"], r["sentiment_polarity"] > 0) for r in sn.score_sentiment(df, "t", "id", lexicon).collect()]
    assert sorted(got, key=str) == sorted([(1, term, True), (1, "nothing", False), (None, term, True), (2, None, False)], key=str)


def test_sentiment_negation_and_intensity(spark, lexicon):
    df = spark.createDataFrame([(1, "not good"), (2, "very good"), (3, "good not")], "id int, t string")
    out = sn.sentiment_scores(df, "t", "id", lexicon, negations=["not"], intensifiers={"very": 2.0})
    assert {r["id"]: r["polarity"] for r in out.collect()} == {1: -0.4, 2: 1.0, 3: 0.8}


def test_sentiment_summary(spark):
    df = spark.createDataFrame([(0.5, "positive"), (-0.5, "negative"), (0.0, "neutral"), (0.4, "positive")],
                               "sentiment_polarity double, sentiment_label string")
    row = sn.sentiment_summary(df).first()
    assert (row["positive_count"], row["negative_count"], row["neutral_count"]) == (2, 1, 1)
    assert row["mean_polarity"] == pytest.approx(0.1)


def test_posts_from_landing_files(spark, lexicon):
    path = scratch_path(spark, "posts")
    now = 1704067200  # 2024-01-01
    rows = [
        ("a", "p1", "Feeling sick", "fever and cough " * 100, float(now), 3, 1, 0.9, "/c/1"),
        ("a", "p2", "Old", "x", float(now - 40 * 86400), 3, 1, 0.9, "/c/2"),
        ("b", "p3", "Hi", None, float(now - 86400), 3, 1, 0.9, "/c/3"),
    ]
    spark.createDataFrame(rows, src.POST_SCHEMA).write.json(path)
    out = {r["post_id"]: r for r in src.read_posts(spark, path, lexicon=lexicon, as_of="2024-01-02 00:00:00").collect()}
    assert set(out) == {"p1", "p3"}
    p1 = out["p1"]
    assert p1["symptoms_mentioned"] == "fever, cough" and p1["is_health_related"]
    assert len(p1["text"]) == 1000 and len(p1["full_text_clean"]) == 1000
    assert p1["sentiment_polarity"] == -0.9 and p1["sentiment_category"] == "Negative"
    assert p1["url"] == "https://reddit.com/c/1" and out["p3"]["text"] is None


def test_short_posts_keep_first_query(spark, lexicon):
    rows = [
        (i, DAY + dt.timedelta(hours=i), "u", "#FluSeason urgent care is good" if i % 2 else "urgent care", 1, 2, 3, "s")
        for i in range(10)
    ]
    raw = spark.createDataFrame(rows, src.SHORT_POST_SCHEMA)
    out = src.shape_short_posts(raw, lexicon, "2024-01-03 00:00:00", limit=4)
    got = {r["tweet_id"]: r["query"] for r in out.collect()}
    # Newest four by hashtag; newest two by phrase, of which one is already there.
    assert got == {9: "#fluseason", 7: "#fluseason", 5: "#fluseason", 3: "#fluseason", 8: '"urgent care"'}


def test_collect_feed(spark):
    feed = spark.createDataFrame([(DAY, "t", 0.1)], "date timestamp, text string, sentiment_polarity double")
    folder = scratch_path(spark, "feeds")
    assert src.collect_feed(feed.limit(0), ["date"], folder, "f", "2024-01-01") is None
    assert src.collect_feed(feed, ["absent"], folder, "f", "2024-01-01") is None
    for day in ("2024-01-01", "2024-01-02"):
        assert src.collect_feed(feed, ["date", "text"], folder, "f", day).count() == 1
    assert src.collect_feed(feed, ["date"], folder, "c", "2024-01-01", "csv").first()["text"] == "t"


def test_ingest_counts(spark):
    got = {r["source"]: r["n"] for r in fd.ingest_counts({"a": spark.range(3), "b": None}).collect()}
    assert got == {"a": 3, "b": 0, "TOTAL": 3}


def test_visits_by_header_name(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame(
        [("0930", "01052021", "41", "z", "1.5"), ("xx", "bad", "old", "y", "2")],
        "ARRTIME string, VDATE string, AGE string, OTHER string, SCORE string",
    ).coalesce(1).write.option("header", True).csv(path)
    df = read_visits(spark, path)
    assert dict(df.dtypes) == {"ARRTIME": "string", "VDATE": "string", "AGE": "int", "OTHER": "string", "SCORE": "string"}
    assert [r["AGE"] for r in df.orderBy("ARRTIME").collect()] == [41, None]
    assert df.orderBy("ARRTIME").first()["VDATE"] == "01052021"
    inferred = read_visits(spark, path, infer_other=True)
    assert dict(inferred.dtypes)["SCORE"] == "double" and dict(inferred.dtypes)["VDATE"] == "string"
    out = scratch_path(spark, "clean")
    write_clean(df, out, "csv")
    assert spark.read.option("header", True).csv(out).count() == 2
    with pytest.raises(ValueError, match="format"):
        write_clean(df, out, "xls")


def _news(spark):
    rows = [(DAY, "u1", "t1", "flu"), (DAY, "u0", "t2", "rsv"), (DAY + dt.timedelta(days=2), "u2", None, "none"), (None, "u", "t", "k")]
    return spark.createDataFrame(rows, "date timestamp, url string, title string, keywords string")


def test_daily_news_in_row_order(spark):
    got = {r["day"].day: (r["news_mentions"], r["keywords"]) for r in dy.daily_news(_news(spark)).collect()}
    assert got == {1: (2, "rsv, flu"), 3: (0, "none")}
    assert "keywords" not in dy.daily_news(_news(spark), with_lists=False).columns


def test_oversized_list_is_refused(spark):
    with pytest.raises(ValueError, match="daily_list_rows"):
        dy.daily_news(_news(spark), max_list_bytes=5)
    rows = dy.daily_list_rows(_news(spark), "keywords", ["date", "url"]).orderBy("day", "position").collect()
    assert [(r["position"], r["item"]) for r in rows] == [(0, "rsv"), (1, "flu"), (0, "none")]


def test_row_lag_and_calendar_lag(spark):
    rows = [(DAY + dt.timedelta(days=d), f"{d}-{i}", "t") for d in (0, 2, 3) for i in range(d + 1)]
    daily = dy.daily_news(spark.createDataFrame(rows, "date timestamp, url string, title string"), with_lists=False)
    by_row = dy.daily_lags(daily, lags=(1,)).orderBy("day").collect()
    assert [r["news_mentions_lag1"] for r in by_row] == [None, 1, 3]
    by_date = dy.daily_lags(daily, lags=(1,), calendar=True).orderBy("day").collect()
    assert [r["news_mentions_lag1"] for r in by_date] == [None, None, 3]


def test_rolling_mean_needs_full_window(spark):
    rows = [(DAY.date() + dt.timedelta(days=i), None if i == 3 else float(i)) for i in range(12)]
    out = dy.daily_rolling_mean(spark.createDataFrame(rows, "day date, reddit_sentiment double"), window=4)
    got = [r["reddit_sentiment_4d"] for r in out.orderBy("day").collect()]
    assert got == [None] * 7 + [5.5, 6.5, 7.5, 8.5, 9.5]


def test_enrich_fills_only_feed_columns(spark):
    visits = spark.createDataFrame([(1, DAY.date()), (2, None), (3, dt.date(2030, 1, 1))], "id int, visit_date date")
    forum = spark.createDataFrame([(DAY, "p", 0.5, "fever")], "date timestamp, post_id string, sentiment_polarity double, symptoms_mentioned string")
    short = spark.createDataFrame([(DAY, 7, 0.2, 3, 4)], "date timestamp, tweet_id bigint, sentiment_polarity double, likes int, retweets int")
    got = {r["id"]: r.asDict() for r in enrich_visits(visits, _news(spark), forum, short, with_lists=True).collect()}
    assert len(got) == 3
    assert got[1]["news_mentions"] == 2 and got[1]["reddit_posts"] == 1 and got[1]["likes"] == 3
    assert got[2]["news_mentions"] == 0 and got[2]["news_mentions_lag7"] == 0 and got[3]["reddit_sentiment"] == 0
    assert got[2]["tweet_count"] is None and got[2]["keywords"] is None and got[2]["twitter_sentiment"] == 0
    alone = enrich_visits(visits, _news(spark).limit(0), with_lists=False)
    assert alone.columns == visits.columns
    with pytest.raises(ValueError, match="both sides"):
        dy.join_short_daily(visits.withColumn("likes", F.lit(1)), short)


def test_lists_are_measured_once_per_day(spark):
    visits = spark.createDataFrame([(1, DAY.date()), (2, DAY.date()), (3, None)], "id int, visit_date date")
    rows = [(DAY, "b", 0.5, "fever"), (DAY, "a", 0.1, None), (DAY, "c", None, "flu")]
    forum = spark.createDataFrame(rows, "date timestamp, post_id string, sentiment_polarity double, symptoms_mentioned string")
    length = {"list_length": F.length("symptoms_mentioned")}
    out = dy.join_forum_daily(visits, forum, per_day=length)
    got = {r["id"]: (r["symptoms_mentioned"], r["list_length"]) for r in out.collect()}
    assert got == {1: ("fever, flu", 10), 2: ("fever, flu", 10), 3: (None, None)}
    with pytest.raises(ValueError, match="both sides"):
        dy.join_forum_daily(visits, forum, per_day={"id": F.length("symptoms_mentioned")})


def test_query_carries_no_list_to_each_visit(spark, small):
    plan = QUERIES["join_forum_daily"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    above = [line for line in plan.splitlines() if "Relation [" not in line]  # a stored table names all its columns
    assert any("list_length" in line for line in above) and not any("symptoms_mentioned" in line for line in above)


def _long_lists(spark):
    """Visits, news and forum with long texts on some days, and the news lists by day."""
    days = [DAY + dt.timedelta(days=i) for i in range(4)]
    rows = [(i, (*days, None)[i % 5], {"x": i}) for i in range(400)] + [(1000 + i, days[0], None) for i in range(300)]
    visits = spark.createDataFrame(rows, "id int, visit_date timestamp, m map<string,int>").repartition(3)
    feed = [(d, "t", f"u{n}", f"{d.day}{n}" * 20_000) for d in days[:3] for n in (1, 2)]
    news = spark.createDataFrame(feed, "date timestamp, title string, url string, keywords string")
    forum = spark.createDataFrame([(days[3], "p", 0.5, "long" * 20_000)], "date timestamp, post_id string, sentiment_polarity double, symptoms_mentioned string")
    return visits, news, forum, {d: ", ".join(f"{d.day}{n}" * 20_000 for n in (1, 2)) for d in days[:3]}


def _parts(out):
    return [p for p in out.select("id", "visit_date", "keywords").rdd.glom().collect() if p]


def test_long_lists_are_given_out_one_day_per_task(spark):
    visits, news, _, lists = _long_lists(spark)
    joined = _parts(dy.join_news_daily(visits, news))
    assert sorted(r["id"] for p in joined for r in p) == sorted(r["id"] for r in visits.collect())
    assert all(r["keywords"] == lists.get(r["visit_date"]) for p in joined for r in p)
    assert all(len({r["keywords"] for r in p}) == 1 for p in joined)
    assert len([p for p in joined if p[0]["visit_date"] == DAY]) > 1  # many visits of a day are cut


def test_filled_and_enriched_visits_are_dealt_out_once(spark):
    visits, news, forum, lists = _long_lists(spark)
    filled = _parts(dy.fill_feed_columns(dy.join_news_daily(visits, news)))
    assert all(len({r["keywords"] for r in p}) == 1 for p in filled)
    both = enrich_visits(visits, news, forum, with_lists=True)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("direct_shuffle_partition_id") == 1
    enriched = _parts(both)
    assert sum(map(len, enriched)) == 700
    assert all(r["keywords"] == lists.get(r["visit_date"]) for p in enriched for r in p)
    assert all(len({r["visit_date"] for r in p if r["visit_date"]}) <= 1 for p in enriched)
    assert both.filter(F.length("symptoms_mentioned") == 80_000).count() == 80
    assert both.filter("reddit_posts = 0").count() == 620


def test_merge_counts_leaves_text_alone(spark):
    visits = spark.createDataFrame([(1, DAY.date(), None, None)], "id int, visit_date date, s string, n int")
    got = dy.merge_counts(visits, news=_news(spark)).first()
    assert (got["cdc_count"], got["n"], got["s"]) == (2, 0, None)
    assert "cdc_count" not in dy.merge_counts(visits, news=_news(spark).limit(0)).columns


def test_broadcast_only_below_the_bound(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")

    def hinted(side):
        return "broadcast" in side._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, max_bytes=500))


def test_limits_reach_the_map_side(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = fd.newest_per_group(docs, "source", 5, "n_chars", "doc_id")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_union_keeps_all_rows(spark):
    out = fd.union_feeds([spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1,)], "a int")])
    assert out.count() == 2 and out.filter("b is null").count() == 1


def test_landing_csv_must_match_its_schema(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("x", 1)], "b string, a int").write.option("header", True).csv(path)
    assert src.read_landing(spark, path, "b string, a int", "csv").count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        src.read_landing(spark, path, "a int, b string", "csv").collect()


def test_top_rows_of_large_groups_are_cut_in_parts(spark):
    from caretide.operators.feeds import limit_per_query, newest_per_group

    posts = spark.range(9000).selectExpr("id AS post_id", "CASE WHEN id % 9 = 0 THEN 'b' ELSE 'a' END AS subreddit", "timestamp_seconds(id % 3000) AS date")
    for k in (1000, 1001, 2500):
        kept = newest_per_group(posts, k=k)
        assert kept.columns == posts.columns
        want = sorted(((-(i % 3000), i) for i in range(9000) if i % 9), key=lambda x: x)[:k]
        assert {r["post_id"] for r in kept.filter("subreddit = 'a'").collect()} == {i for _, i in want}
        assert kept.filter("subreddit = 'b'").count() == min(k, 1000)
    matches = posts.selectExpr("post_id AS tweet_id", "date", "0 AS query_no", "true AS is_hashtag")
    limited = limit_per_query(matches, 1500, 10)
    assert sorted(r["position"] for r in limited.collect()) == list(range(1, 1501))
    want = sorted(((i % 3000, i) for i in range(9000)), reverse=True)[:1500]
    assert {r["tweet_id"] for r in limited.collect()} == {i for _, i in want}
