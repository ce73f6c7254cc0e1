"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app: str = "caretide", **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, as named in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="caretide-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/caretide-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a step must not be recomputed differently (range partition ids)
    or would be recomputed many times. Parquet rather than ``checkpoint()``
    because later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark ``df`` for broadcast only if a measurement proves that it is small.

    Beyond the bound the frame comes back without a hint and the join runs as a
    shuffle join, with adaptive skew handling.
    """
    fixed = sum(8 for f in df.schema.fields)
    width = F.lit(fixed)
    for field in df.schema.fields:
        if field.dataType.simpleString() == "string":
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif field.dataType.simpleString().startswith(("array", "map", "struct", "binary")):
            return df
    size = df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= max_bytes else df


def measured_side(df: DataFrame, label: str = "side", max_bytes: int = 64 << 20) -> DataFrame:
    """A join side stored once, then measured: broadcast if small, else unhinted."""
    return broadcast_if_small(materialize(df, label), max_bytes)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer input splits than cores, dealt out evenly.

    For costly per-row work (regular expressions, HTML) on small or unsplittable
    files. Call it right after reading; a large scan is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
