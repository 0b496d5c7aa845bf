"""Telemetry files: preamble rows, no header, eight columns by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planact import schemas

# --- fixed values ----------------------------------------------------------------------------
GERMAN_TIMESTAMP = r"^\d{1,2}\.\d{1,2}\.\d{4} "
GERMAN_FORMAT = "d.M.yyyy H:mm[:ss]"
# ---------------------------------------------------------------------------------------------

RAW = T.StructType([T.StructField(c, T.StringType()) for c in schemas.TELEMETRY_FEED])


def parse(raw: DataFrame) -> DataFrame:
    """Text rows to typed rows. The preamble has no timestamp in its first cell and drops out
    together with data rows that lack one."""
    sensors = [_sensor(feed).alias(name) for feed, name in schemas.TELEMETRY_FEED.items() if name != "ts"]
    extra = [c for c in raw.columns if c not in schemas.TELEMETRY_FEED]
    return raw.select(_stamp().alias("ts"), *sensors, *extra).where(F.col("ts").isNotNull())


def _stamp() -> Column:
    stamp = F.trim("Zeitstempel")
    german = F.when(
        stamp.rlike(GERMAN_TIMESTAMP), F.try_to_timestamp(stamp, F.lit(GERMAN_FORMAT)).cast("timestamp_ntz")
    )
    return F.coalesce(stamp.try_cast("timestamp_ntz"), german)


def _sensor(feed: str) -> Column:
    return F.trim(feed).try_cast("decimal(10,2)")


def row_counts() -> list[Column]:
    """Aggregates over text rows: all, those without a timestamp (the preamble among them), and bad cells by sensor."""
    bad = [
        F.count_if(F.col(feed).isNotNull() & _sensor(feed).isNull() & _stamp().isNotNull()).alias(name)
        for feed, name in schemas.TELEMETRY_FEED.items()
        if name != "ts"
    ]
    return [F.count(F.lit(1)).alias("rows"), F.count_if(_stamp().isNull()).alias("without_time"), *bad]


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """(path, source_file) of all matching files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def read_telemetry_files(spark: SparkSession, folder: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Text rows of all matching files, with the file each came from."""
    raw = spark.read.schema(RAW).option("mode", "PERMISSIVE").option("pathGlobFilter", glob).csv(folder)
    return raw.select("*", F.col("_metadata.file_name").alias("source_file"))


def stream_telemetry_files(
    spark: SparkSession, folder: str, glob: str = "*.csv", files_per_batch: int | None = None
) -> DataFrame:
    """The same rows as a stream; each file is read once per checkpoint."""
    reader = spark.readStream.schema(RAW).option("mode", "PERMISSIVE").option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).select("*", F.col("_metadata.file_name").alias("source_file"))
