"""Production days as event-time windows.

The session must run in UTC: windows over TIMESTAMP align to it, and the plant's local
timestamps are carried over unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.functions.dates import PRODUCTION_DAY_START_HOUR
from planact.operators.telemetry import SUMMED
from planact.sinks.tables import MONTH, month_of


def production_days(telemetry: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Sensor sums per 24-hour window from 06:00; rows later than ``lateness`` are dropped.

    One state row per open production day: a few days at most.
    """
    timed = telemetry.withColumn("event_ts", F.col("ts").cast("timestamp")).withWatermark("event_ts", lateness)
    window = F.window("event_ts", "1 day", startTime=f"{PRODUCTION_DAY_START_HOUR} hours")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("decimal(20,2)").alias(c) for c in SUMMED]
    return (
        timed.groupBy(window)
        .agg(*sums)
        .select(F.to_date(F.col("window.start")).alias("day"), *SUMMED)
        .withColumn(MONTH, month_of("day"))
    )
