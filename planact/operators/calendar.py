"""Calendars and the time dimension.

A calendar is generated inside the plan from two dates the caller passes, so its size
(days of the interval) is known before the job starts: at most one row per day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.functions import dates
from planact.schemas import PART_MONTH

DateLike = str | dt.date

def as_date(value: DateLike) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value[:10])


def date_lit(value: DateLike) -> Column:
    return F.lit(as_date(value))


def month_of(value: DateLike) -> dt.date:
    return as_date(value).replace(day=1)


def end_of_month(value: DateLike) -> dt.date:
    first = month_of(value)
    nxt = (first + dt.timedelta(days=32)).replace(day=1)
    return nxt - dt.timedelta(days=1)


def days(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(date_lit(start), date_lit(end), F.expr("INTERVAL '1' DAY"))
        ).alias("day")
    )


def months(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """First days of the months whose first day lies in the interval."""
    lo, hi = as_date(start), as_date(end)
    first = lo if lo.day == 1 else (end_of_month(lo) + dt.timedelta(days=1))
    if first > hi:
        return spark.range(0).select(F.lit(first).alias("month"))
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(hi), F.expr("INTERVAL '1' MONTH"))).alias("month")
    )


def each_day(df: DataFrame, start: Column, end: Column, name: str = "day") -> DataFrame:
    """Repeat every row for each day from ``start`` to ``end``.

    A generator over the row's own interval: no join, no shuffle, output-sized work.
    """
    return df.withColumn(name, F.explode(F.sequence(start, end, F.expr("INTERVAL '1' DAY"))))


def _members(dates_df: DataFrame, grain: str, is_month: bool) -> DataFrame:
    d = F.col(grain)
    return dates_df.where(d.isNotNull()).select(
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        (F.lit(0) if is_month else F.dayofmonth(d)).alias("day"),
        F.lit(is_month).alias("is_month"),
    ).distinct()


def month_members(dates_df: DataFrame, column: str = "month") -> DataFrame:
    """Month-level members (day 0) of the time dimension."""
    return _members(dates_df.select(dates.month_start(F.col(column)).alias("m")), "m", True)


def day_members(dates_df: DataFrame, column: str = "day") -> DataFrame:
    """Day-level members of the time dimension."""
    return _members(dates_df.select(F.col(column).alias("d")), "d", False)


def member_date(dim_time: DataFrame) -> DataFrame:
    """Add ``date`` to day-level members; month-level members carry null."""
    return dim_time.withColumn("date", dates.date_from_parts(F.col("year"), F.col("month"), F.col("day")))


def missing_members(dim_time: DataFrame, new: DataFrame) -> DataFrame:
    """New members not stored yet, matched per grain.

    A month-level member is skipped as soon as any member of that month is stored; a
    day-level member only by its own day. Each grain is one anti-join on its key.
    """
    new_months = new.where("is_month").join(
        dim_time.select("year", "month").distinct(), ["year", "month"], "left_anti"
    )
    new_days = new.where("not is_month").join(
        dim_time.where("not is_month").select("year", "month", "day").distinct(),
        ["year", "month", "day"],
        "left_anti",
    )
    return new_months.unionByName(new_days)


def key_of_month(dim_time: DataFrame) -> DataFrame:
    """Months the time dimension knows, as DATE: any member of a month makes it known."""
    return dim_time.select(F.make_date("year", "month", F.lit(1)).alias("month")).distinct()


def key_of_day(dim_time: DataFrame) -> DataFrame:
    """Days the time dimension knows, as DATE."""
    return (
        dim_time.where("day > 0")
        .select(F.make_date("year", "month", F.greatest(F.col("day"), F.lit(1))).alias("day"))
        .distinct()
    )


def in_interval(df: DataFrame, start: DateLike | None, end: DateLike | None, column: str = "day") -> DataFrame:
    """Rows between two days, both included; an open end is not filtered.

    A frame that carries the month its table is partitioned by is also filtered on that
    month, so that only the partitions of the interval are listed and read.
    """
    parted = PART_MONTH in df.columns
    if start is not None:
        df = df.where(F.col(column) >= date_lit(start))
        df = df.where(F.col(PART_MONTH) >= F.lit(month_of(start))) if parted else df
    if end is not None:
        df = df.where(F.col(column) <= date_lit(end))
        df = df.where(F.col(PART_MONTH) <= F.lit(month_of(end))) if parted else df
    return df
