"""Production days that stay right however late their rows come.

A windowed stream gives up on a day once its watermark has passed; rows behind it are dropped. Here every micro-batch is stored first and
the days it touches are summed up again from the stored rows, which needs no state between batches. Rows that a
watermark would have dropped are also listed in a table of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from planact import schemas
from planact.functions import dates
from planact.operators import dedupe
from planact.operators import telemetry as ops
from planact.session import stage, staging
from planact.sinks import tables as sink
from planact.sources import ledger, telemetry
from planact.sources.tables import exists, read_or_empty

MONTH = schemas.PART_MONTH


def rebuilt_days(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """The sums of some production days (``touched``: distinct ``day``) from the stored telemetry.

    A production day lies in its own calendar day and the next, so only the months of these are read.
    """
    around = touched.select(F.explode(F.array("day", F.date_add("day", 1))).alias("day"))
    months = dedupe.touched_partitions(around, sink.month_of("day"), MONTH)
    rows = stored.join(months, MONTH, "left_semi") if MONTH in stored.columns else stored
    rows = rows.withColumn("day", dates.production_day(F.col("ts"))).join(touched, "day", "left_semi")
    return ops.by_production_day(rows.drop("day"))


def ingest_and_correct(
    spark: SparkSession,
    folder: str,
    table: str,
    days: str,
    late: str,
    checkpoint: str,
    lateness: dt.timedelta = dt.timedelta(days=1),
    available_now: bool = True,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Telemetry files into ``table``, their production days into ``days``, rows later than ``lateness`` into ``late`` too.

    Late is what belongs to a day that ended ``lateness`` or more before the latest day known by then. A repeated micro-batch stores no file
    twice, and sums the same days up again.
    """
    raw = telemetry.stream_telemetry_files(spark, folder, files_per_batch=files_per_batch)

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            rows = stage(batch.withColumn("day", dates.production_day(F.col("ts"))), "telemetry-batch")
            schema = ops.by_production_day(rows).withColumn(MONTH, sink.month_of("day")).schema
            known = read_or_empty(spark, days, schema).agg(F.max("day")).first()[0]
            if known is not None:
                behind = F.date_add("day", 1 + lateness.days) <= F.lit(known)
                rows.where(behind).write.mode("overwrite").parquet(f"{late}/batch={number}")
            new = rows.drop("day")
            if exists(spark, table):
                new = ledger.pending_rows(new, spark.read.parquet(table).select("source_file"))
            sink.append_telemetry(new, table)
            touched = stage(rows.select("day").where("day is not null").distinct(), "touched-days")
            again = rebuilt_days(spark.read.parquet(table), touched).withColumn(MONTH, sink.month_of("day"))
            sink.upsert_partitions(spark, days, schema, again, ["day"], MONTH)

    writer = telemetry.parse(raw).writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
