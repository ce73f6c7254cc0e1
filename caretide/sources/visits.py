"""Reading and writing the visit extract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from caretide.operators.schema import col

# Types of the known columns. Packed dates, clocks and codes stay
# text so that leading zeros survive.
VISIT_TYPES = {
    "AGE": "int", "SEX": "int", "ETHNIC": "int", "RACEUN": "string",
    "VDATE": "string", "VMONTH": "int", "VDAYR": "int", "ARRTIME": "string",
    "WAITTIME": "int", "TIMEMD": "int", "LOS": "int", "IMMEDR": "int",
    "DIAG1": "string", "DIAG2": "string", "DIAG3": "string",
    "RFV1": "string", "RFV2": "string", "RFV3": "string",
    "CAUSE1": "string", "CAUSE2": "string", "CAUSE3": "string",
    "PAYTYPER": "int", "PAYTYPE": "int",
    "IMAGING": "int", "XRAY": "int", "CATSCAN": "int", "MRI": "int",
    "BLOODCUL": "int", "URINE": "int",
    "DISCHAR": "int", "ADMITHOS": "int", "LEFTBTRT": "int",
}


def read_visits(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    infer_other: bool = False,
    fmt: str = "csv",
) -> DataFrame:
    """The visit extract as a typed table; a cell that does not fit becomes null.

    Columns are taken by the header's names, whatever their order. Known columns
    get their contract type, overridden by ``types``; others stay text unless
    ``infer_other`` lets Spark look at the data (one more pass). Files whose headers
    name other columns, or in another order, fail when they are read. ``fmt`` may also
    be ``parquet``: known columns get their type there too.
    """
    wanted = {**VISIT_TYPES, **(types or {})}
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        header = spark.read.option("header", True).csv(path).schema
        raw = spark.read.option("header", True).option("enforceSchema", False).schema(header).csv(path)
    if infer_other and fmt != "parquet":
        seen = spark.read.option("header", True).option("inferSchema", True).csv(path)
        wanted = {**dict(seen.dtypes), **wanted}
    return raw.select(
        *[
            col(n).try_cast(wanted[n]).alias(n) if n in wanted and dict(raw.dtypes)[n] != wanted[n] else col(n)
            for n in raw.columns
        ]
    )


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a cleaned table, one file per task."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
