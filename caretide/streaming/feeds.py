"""Feeds as file streams: ingest, de-duplication and daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caretide.operators.schema import col


def read_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    fmt: str = "json",
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files arriving below ``path`` as a stream with an explicit schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_ingest(
    feed: DataFrame, path: str, checkpoint: str, date_column: str = "date", fmt: str = "parquet"
) -> StreamingQuery:
    """Append everything that has arrived, partitioned by day, then stop.

    The checkpoint remembers what was read, so a rerun takes only new files and
    a lost executor repeats its part without double rows.
    """
    dated = feed.withColumn("ingest_date", F.to_date(col(date_column)))
    return (
        dated.writeStream.format(fmt)
        .partitionBy("ingest_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup(
    feed: DataFrame, id_column: str, date_column: str = "date", delay: str = "7 days"
) -> DataFrame:
    """One row per id; state is kept for ``delay`` of event time only."""
    return feed.withWatermark(date_column, delay).dropDuplicatesWithinWatermark([id_column])


def stream_daily_counts(
    feed: DataFrame,
    date_column: str = "date",
    polarity: str = "sentiment_polarity",
    delay: str = "2 days",
) -> DataFrame:
    """``(day, posts, mean_polarity)`` per day; rows later than the watermark are dropped."""
    return (
        feed.withWatermark(date_column, delay)
        .groupBy(F.window(col(date_column), "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("posts"), F.avg(col(polarity)).alias("mean_polarity"))
        .select(F.to_date("w.start").alias("day"), "posts", "mean_polarity")
    )


def write_updates(daily: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store changed days of every batch below ``path/batch=N``, replacing a repeat of N."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        daily.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def latest_days(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every day written by ``write_updates``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in ("day", "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("v")
    return rows.groupBy("day").agg(newest).select("day", "v.*")
