"""Reports of all months, stored by month and kept up to date: only months that were touched are computed again.

Loads note the months they touched in a table of changes. ``refresh`` reads what was noted, cuts every input to
those months, computes the reports from that and puts the months in place of the stored ones. Notes are deleted last: what was
interrupted is done again, with the same result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planact import schemas
from planact.functions import dates
from planact.operators import calendar as cal
from planact.plans import category_sums, daily_report, legacy_report
from planact.plans.inputs import Inputs
from planact.session import remove
from planact.sinks import tables as sink
from planact.sources.tables import partition_values

MONTH = schemas.PART_MONTH


def _daily(inputs: Inputs, months: Sequence[dt.date]) -> DataFrame:
    return daily_report.daily_history(inputs).withColumn(MONTH, sink.month_of("day"))


def _sums(inputs: Inputs, months: Sequence[dt.date]) -> DataFrame:
    return category_sums.category_sums_history(inputs).withColumn(MONTH, F.col("month").cast("date"))


def _legacy(inputs: Inputs, months: Sequence[dt.date]) -> DataFrame:
    rows = legacy_report.legacy_rows(inputs, min(months), cal.end_of_month(max(months)))
    return rows.withColumn(MONTH, sink.month_of(legacy_report.KEY)).where(_among(F.col(MONTH), months))


Report = Callable[[Inputs, Sequence[dt.date]], DataFrame]
REPORTS: dict[str, Report] = {"daily": _daily, "category_sums": _sums, "legacy": _legacy}


def _among(month: Column, months: Sequence[dt.date]) -> Column:
    return month.isin([F.lit(m) for m in months])


def note_changes(days: DataFrame, folder: str) -> None:
    """Note the months of some days (a column ``day``) as touched; for telemetry these are production days."""
    months = days.select(F.to_date(F.trunc("day", "MM")).alias("month")).where("month is not null").distinct()
    months.write.parquet(f"{folder}/change={uuid.uuid4().hex}")


def cut(inputs: Inputs, months: Sequence[dt.date]) -> Inputs:
    """The rows that reports of some months are made of.

    Tables partitioned by month are cut by partition, others by a range and the months inside it. A month's telemetry ends
    at 06:00 of the next one.
    """
    lo, hi = min(months), cal.end_of_month(max(months))

    def by_day(df: DataFrame) -> DataFrame:
        df = df.where(F.col("day").between(F.lit(lo), F.lit(hi)) & _among(sink.month_of("day"), months))
        return df.where(_among(F.col(MONTH), months)) if MONTH in df.columns else df

    reach = sorted({*months, *(cal.end_of_month(m) + dt.timedelta(days=1) for m in months)})
    start = dt.datetime.combine(lo, dt.time())
    stop = dt.datetime.combine(hi + dt.timedelta(days=2), dt.time())
    telemetry = inputs.telemetry.where(
        (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(stop).cast("timestamp_ntz"))
        & _among(F.to_date(F.trunc(dates.production_day(F.col("ts")), "MM")), months)
    )
    if MONTH in telemetry.columns:
        telemetry = telemetry.where(_among(F.col(MONTH), reach))
    return replace(
        inputs,
        movements=by_day(inputs.movements),
        plan=inputs.plan.where(_among(F.col("month"), months)),
        shutdown=by_day(inputs.shutdown),
        telemetry=telemetry,
    )


def refresh(
    spark: SparkSession, inputs: Inputs, changes: str, root: str, reports: dict[str, Report] | None = None
) -> list[dt.date]:
    """Compute the noted months of every report again and put them in place, below ``root``; the months.

    Facts are only ever added, so a month that has rows keeps having some. One that a report has no rows for is left as it is.
    """
    noted = sorted(partition_values(spark, changes, "change"))
    if not noted:
        return []
    paths = [f"{changes}/change={c}" for c in noted]
    found = spark.read.schema("month date").parquet(*paths).distinct().collect()  # months of a calendar
    months = sorted(r["month"] for r in found)
    if months:
        part = cut(inputs, months)
        for name, build in (REPORTS if reports is None else reports).items():
            sink.replace_partitions(build(part, months), f"{root}/{name}", MONTH)
    for path in paths:
        remove(spark, path)
    return months
