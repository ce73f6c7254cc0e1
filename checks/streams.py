"""The stream operators over the given tables, run until all input is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide.session import scratch_path
from caretide.streaming import feeds as st
from checks.registry import duck_date, query, rounded, text_date, view, with_views

_SCHEMA = "post_id string, date timestamp, sentiment_polarity double"


def _arrivals(spark, sf):
    """Posts as landing files, in several batches."""
    path = scratch_path(spark, "arrivals")
    posts = view(spark, sf, "v_posts").select("post_id", "date", "sentiment_polarity")
    posts.repartitionByRange(4, "date").sortWithinPartitions("date").write.parquet(path)
    return path


def _stream(spark, path, files=None):
    return st.read_stream(spark, path, _SCHEMA, "parquet", max_files=files)


@query(
    "stream_ingest",
    with_views("v_posts")
    + f""" SELECT post_id, round(sentiment_polarity, 6) AS sentiment_polarity,
    {duck_date('CAST(date AS DATE)')} AS ingest_date FROM v_posts""",
)
def stream_ingest(spark, sf):
    landing = _arrivals(spark, sf)
    out, marks = scratch_path(spark, "sink"), scratch_path(spark, "marks")
    for _ in range(2):  # the second run finds nothing new
        st.stream_ingest(_stream(spark, landing, 1), out, marks).awaitTermination()
    stored = spark.read.parquet(out)
    return rounded(stored, "sentiment_polarity").select(
        "post_id", "sentiment_polarity", text_date("ingest_date").alias("ingest_date")
    )


@query("stream_dedup", with_views("v_posts") + " SELECT post_id, 1::BIGINT AS n FROM v_posts")
def stream_dedup(spark, sf):
    """Every post arrives twice."""
    path = scratch_path(spark, "arrivals")
    posts = view(spark, sf, "v_posts").select("post_id", "date", "sentiment_polarity")
    posts.unionByName(posts).write.parquet(path)
    unique = st.stream_dedup(_stream(spark, path), "post_id", delay="60 days")
    out, marks = scratch_path(spark, "sink"), scratch_path(spark, "marks")
    st.stream_ingest(unique, out, marks).awaitTermination()
    return spark.read.parquet(out).groupBy("post_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_daily_counts",
    with_views("v_posts")
    + f""" SELECT {duck_date('CAST(date AS DATE)')} AS day, count(*) AS posts,
    round(avg(sentiment_polarity), 6) AS mean_polarity FROM v_posts GROUP BY 1""",
)
def stream_daily_counts(spark, sf):
    daily = st.stream_daily_counts(_stream(spark, _arrivals(spark, sf), 1), delay="60 days")
    out, marks = scratch_path(spark, "sink"), scratch_path(spark, "marks")
    st.write_updates(daily, out, marks).awaitTermination()
    return rounded(st.latest_days(spark, out), "mean_polarity").withColumn("day", text_date("day"))
