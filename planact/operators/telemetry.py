"""Plant telemetry per production day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import dates
from planact.functions import rounding as r
from planact.operators import calendar as cal
from planact.schemas import PART_MONTH

SUMMED = ("run_flag", "feed", "dust_set", "dust_out", "coal", "slag")

# --- fixed values -----------------------------------------------------------------------
HOURS_PER_DAY = 24
# ----------------------------------------------------------------------------------------


def in_report_range(telemetry: DataFrame, start: cal.DateLike) -> DataFrame:
    """Rows of the month of ``start`` and the day after it, as a range on ``ts`` itself."""
    first = dt.datetime.combine(cal.month_of(start), dt.time())
    stop = dt.datetime.combine(cal.end_of_month(start) + dt.timedelta(days=2), dt.time())
    ts = F.col("ts")
    if PART_MONTH in telemetry.columns:
        telemetry = telemetry.where(F.col(PART_MONTH).between(F.lit(first.date()), F.lit(cal.month_of(stop.date()))))
    return telemetry.where(
        (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(stop).cast("timestamp_ntz"))
    )


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("decimal(20,2)").alias(name)


def by_production_day(telemetry: DataFrame) -> DataFrame:
    """Sums per 06:00 production day; a day without a sensor value counts 0."""
    return telemetry.groupBy(dates.production_day(F.col("ts")).alias("day")).agg(*[_sum(c) for c in SUMMED])


def day_figures(per_day: DataFrame) -> DataFrame:
    """Availability, average feed and slag content; the day always has 24 hours."""

    def average(name: str, factor: int = 1) -> Column:
        scaled = F.col(name).cast("decimal(18,2)") * F.lit(factor).cast("decimal(3,0)")
        return r.half_even(scaled / F.lit(HOURS_PER_DAY).cast("decimal(2,0)"), 2).cast("decimal(20,2)")

    return per_day.select(
        "day",
        average("run_flag", 100).alias("availability_pct"),
        average("feed").alias("avg_feed"),
        average("slag").alias("pb_in_slag"),
        (F.col("dust_set") + F.col("dust_out") + F.col("coal")).cast("decimal(22,2)").alias("returned_dust"),
    )
