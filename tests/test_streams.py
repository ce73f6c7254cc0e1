"""Streams over files that arrive in several batches."""

import datetime as dt

from pyspark.sql import functions as F

from caretide.session import scratch_path
from caretide.streaming import feeds as st

SCHEMA = "id bigint, date timestamp, sentiment_polarity double"
DAY = dt.datetime(2024, 1, 1, 12)


def _arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_ingest_takes_new_files_once(spark):
    landing, out, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    for n in (1, 2):
        _arrive(spark, landing, [(n, DAY + dt.timedelta(days=n), 0.1)])
        st.stream_ingest(st.read_stream(spark, landing, SCHEMA), out, marks).awaitTermination()
        assert spark.read.parquet(out).count() == n
    assert "ingest_date" in spark.read.parquet(out).columns


def test_dedup_across_batches(spark):
    landing, out, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    for rows in ([(1, DAY, 0.1), (1, DAY, 0.1)], [(1, DAY, 0.1), (2, DAY, 0.2)]):
        _arrive(spark, landing, rows)
        unique = st.stream_dedup(st.read_stream(spark, landing, SCHEMA), "id")
        st.stream_ingest(unique, out, marks).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_daily_counts_equal_batch_and_drop_late_rows(spark):
    landing, out, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    on_time = [(i, DAY + dt.timedelta(days=i // 4), i / 10) for i in range(20)]
    batches = [on_time[:8], [(100, DAY, 0.3), *on_time[8:]], [(200, DAY, 9.0)]]
    for rows in batches:
        _arrive(spark, landing, rows)
        daily = st.stream_daily_counts(st.read_stream(spark, landing, SCHEMA), delay="1 day")
        st.write_updates(daily, out, marks).awaitTermination()
    got = {r["day"]: (r["posts"], round(r["mean_polarity"], 9)) for r in st.latest_days(spark, out).collect()}
    kept = spark.createDataFrame([*on_time, (100, DAY, 0.3)], SCHEMA)
    want = kept.groupBy(F.to_date("date").alias("day")).agg(F.count("id").alias("n"), F.avg("sentiment_polarity").alias("m"))
    assert got == {r["day"]: (r["n"], round(r["m"], 9)) for r in want.collect()}
