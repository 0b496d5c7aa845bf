"""Monthly plan, shutdown hours and the allocation of the plan to days.

The plan is a long table (version, material_id, month, measure, value), shutdown hours are
(version, day, measure, hours). Allocation is done for every version, month and slice in
one pass: totals are grouped to the slice first (rounding is defined on the slice), joined
once with the shutdown days of their period, and only then opened up into days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import dates
from planact.functions import rounding as r
from planact.operators import calendar as cal

BUDGET = "budget"
FORECAST = "forecast"

# --- fixed values ---------------------------------------------------------------------
MEASURE_PREFIX = {BUDGET: "b_", FORECAST: "f_"}
HOURS_PER_DAY = 24
MIN_WORKING_HOURS = 3
PLAN_DIGITS = 3
# --------------------------------------------------------------------------------------

_MONEY = "decimal(20,2)"
_SECONDS = "decimal(7,0)"
_HOURS = "decimal(14,6)"
_TOTAL = "decimal(24,3)"
_RATE = "decimal(20,3)"


# --- reshaping --------------------------------------------------------------------------


def unpivot_months(wide: DataFrame, ids: Sequence[str], zero_for_null: bool = True) -> DataFrame:
    """Columns ``b_jan_25`` / ``f_jan_25`` to rows (ids, measure, month, value)."""
    cells = []
    for measure, prefix in MEASURE_PREFIX.items():
        for name in wide.columns:
            if name.startswith(prefix):
                value = F.col(name).cast("decimal(18,2)")
                if zero_for_null:
                    value = F.coalesce(value, F.lit(0).cast("decimal(18,2)"))
                month = F.lit(dates.label_month(name.removeprefix(prefix)))
                cells.append(
                    F.struct(F.lit(measure).alias("measure"), month.alias("month"), value.alias("value"))
                )
    return wide.select(*ids, F.inline(F.array(*cells)))


def months_of(plan: DataFrame) -> list[dt.date]:
    """The months of a plan in order; DATE holds at most 120,000 of them."""
    return [r[0] for r in plan.where(F.col("month").isNotNull()).select("month").distinct().orderBy("month").collect()]


def month_columns(months: Sequence[dt.date], measures: Sequence[str] = (BUDGET, FORECAST)) -> list[str]:
    return [f"{MEASURE_PREFIX[m]}{d.strftime('%b_%y').lower()}" for m in measures for d in months]


def pivot_months(
    plan: DataFrame,
    ids: Sequence[str],
    months: Sequence[dt.date] | None = None,
    measures: Sequence[str] = (BUDGET, FORECAST),
) -> DataFrame:
    """Back to one column per measure and month.

    Without ``months`` the columns are those of the months in the plan, found by one aggregation: a
    frame's columns must be known before it is built. ``months`` chooses some of them.
    """
    months = months_of(plan) if months is None else months
    prefix = F.when(F.col("measure") == BUDGET, MEASURE_PREFIX[BUDGET]).otherwise(MEASURE_PREFIX[FORECAST])
    labelled = plan.withColumn("column", F.concat(prefix, dates.month_label(F.col("month"))))
    # Spread by id, rows move once: cells are summed and wide rows gathered where they are, and held for the ids of a task
    # only. A plan names a material once for a month and version, so no id is hot.
    cells = labelled.select(*ids, "column", "value").repartition(*ids).groupBy(*ids, "column").agg(F.sum("value").alias("value"))
    return cells.groupBy(*ids).pivot("column", month_columns(months, measures)).agg(
        F.sum("value").cast("decimal(18,2)")
    )


# --- monthly plan -------------------------------------------------------------------------


def in_version(df: DataFrame, version: str | None) -> DataFrame:
    return df if version is None else df.where(F.col("version") == version)


def pool_versions(df: DataFrame) -> DataFrame:
    """Treat all versions as one, as a request without a version does."""
    return df.withColumn("version", F.lit("*"))


def in_months(plan: DataFrame, start: cal.DateLike, end: cal.DateLike) -> DataFrame:
    """Months whose first day lies in the interval."""
    return plan.where(F.col("month").between(cal.date_lit(start), cal.date_lit(end)))


def _sum_of(measure: str) -> Column:
    value = F.when(F.col("measure") == measure, F.col("value"))
    return F.coalesce(F.sum(value), F.lit(0)).cast(_MONEY).alias(measure)


def monthly_plan(plan: DataFrame, keys: Sequence[str] = ("version", "material_id", "month")) -> DataFrame:
    """Budget and forecast per version, material and month; 0 where a measure is missing."""
    return (
        plan.where(F.col("material_id").isNotNull()).groupBy(*keys).agg(_sum_of(BUDGET), _sum_of(FORECAST))
    )


def monthly_slices(monthly: DataFrame, materials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly plan of the known materials, summed to ``by`` (columns of ``materials``).

    The plan is already one row per material and month here, so this join moves the
    reduced frame only.
    """
    keys = [c for c in by if c != "material_id"]
    known = monthly.join(materials.select("material_id", *keys), "material_id")
    return known.groupBy("version", "month", *by).agg(
        *[F.sum(m).cast(_MONEY).alias(m) for m in (BUDGET, FORECAST)]
    )


def plan_slices(plan: DataFrame, materials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``monthly_slices`` of ``monthly_plan``, for slices that are all that is asked for.

    Rows meet their material first and are then summed to the slice where they are: sums are exact, so the frame per
    material and month, nearly as long as the plan itself, need not be made and shuffled.
    """
    keys = [c for c in by if c != "material_id"]
    known = plan.join(materials.select("material_id", *keys), "material_id")
    return known.groupBy("version", "month", *by).agg(_sum_of(BUDGET), _sum_of(FORECAST))


def plan_by_month_map(plan: DataFrame) -> DataFrame:
    """material_id, measure and a map month label -> value (one entry per month)."""
    summed = (
        plan.where(F.col("material_id").isNotNull())
        .groupBy("material_id", "measure", dates.month_label(F.col("month")).alias("label"))
        .agg(F.coalesce(F.sum("value"), F.lit(0)).cast(_MONEY).alias("value"))
    )
    # A label is there once, so nothing is gained by lists before the shuffle.
    return summed.repartition("material_id", "measure").groupBy("material_id", "measure").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "value")))).alias("by_month")
    )


# --- proration ------------------------------------------------------------------------------


def _share_of_month(value: Column, seconds: Column, month: Column) -> Column:
    whole = (dates.days_in_month(month) * 86_400).cast(_SECONDS)
    return value * seconds.cast(_SECONDS) / whole


def prorated_totals(
    slices: DataFrame, start: dt.datetime, end: dt.datetime, by: Sequence[str] = ()
) -> DataFrame:
    """Plan of an interval, from monthly values spread evenly over the hours of their month.

    A month counts if its first day lies in the interval. The month of ``end`` counts up to
    ``end``, earlier months up to one second before midnight.
    """
    first = F.lit(start).cast("timestamp_ntz")
    last = F.lit(end).cast("timestamp_ntz")
    month_ts = F.col("month").cast("timestamp_ntz")
    is_last = F.col("month") == F.lit(end.date().replace(day=1))
    until = F.when(is_last, last).otherwise(
        F.date_add(F.last_day("month"), 1).cast("timestamp_ntz") - F.expr("INTERVAL '1' SECOND")
    )
    seconds = dates.seconds_between(F.greatest(month_ts, first), until)
    counted = slices.where((month_ts >= first) & (month_ts <= last))
    return counted.groupBy("version", *by).agg(
        *[
            r.half_even(F.sum(_share_of_month(F.col(m), seconds, F.col("month"))), PLAN_DIGITS)
            .cast(_TOTAL)
            .alias(f"{m}_total")
            for m in (BUDGET, FORECAST)
        ]
    )


def full_month_totals(slices: DataFrame) -> DataFrame:
    """The same for every month on its own, from 00:00 of its first to 23:59 of its last day."""
    seconds = dates.days_in_month(F.col("month")) * 86_400 - 60
    return slices.select(
        *[c for c in slices.columns if c not in (BUDGET, FORECAST)],
        *[
            r.half_even(_share_of_month(F.col(m), seconds, F.col("month")), PLAN_DIGITS)
            .cast(_TOTAL)
            .alias(f"{m}_total")
            for m in (BUDGET, FORECAST)
        ],
    )


# --- shutdown hours ----------------------------------------------------------------------------


def positive_hours(shutdown: DataFrame) -> DataFrame:
    return shutdown.where(F.col("hours") > 0)


def shutdown_between(
    shutdown: DataFrame, start: cal.DateLike, end: cal.DateLike, version: str | None = None
) -> DataFrame:
    """Days with shutdown hours, budget and forecast side by side."""
    chosen = in_version(positive_hours(shutdown), version).where(
        F.col("day").between(cal.date_lit(start), cal.date_lit(end))
    )
    return shutdown_by_day(chosen)


def shutdown_on_calendar(shutdown: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Positive shutdown rows whose day the time dimension knows."""
    return positive_hours(shutdown).join(cal.key_of_day(dim_time), "day")


def _hours_of(measure: str) -> Column:
    hours = F.when(F.col("measure") == measure, F.col("hours").cast("decimal(12,6)"))
    return F.coalesce(F.sum(hours), F.lit(0)).cast(_HOURS).alias(f"{measure}_hours")


def shutdown_by_day(shutdown: DataFrame) -> DataFrame:
    return positive_hours(shutdown).groupBy("version", "day").agg(_hours_of(BUDGET), _hours_of(FORECAST))


def shutdown_totals(
    shutdown: DataFrame, start: cal.DateLike | None = None, end: cal.DateLike | None = None
) -> DataFrame:
    """Shutdown hours per version over the interval."""
    chosen = positive_hours(shutdown)
    if start is not None and end is not None:
        chosen = chosen.where(F.col("day").between(cal.date_lit(start), cal.date_lit(end)))
    return chosen.groupBy("version").agg(_hours_of(BUDGET), _hours_of(FORECAST))


def _shutdown_periods(shutdown: DataFrame, period: Column) -> DataFrame:
    """One row per version and period: hours in total, and per day as a map.

    The map holds at most one entry per day of the period.
    """
    per_day = shutdown_by_day(shutdown)
    hours = F.struct(f"{BUDGET}_hours", f"{FORECAST}_hours")
    return per_day.groupBy("version", period.alias("period")).agg(
        *[F.sum(f"{m}_hours").cast(_HOURS).alias(f"{m}_shutdown") for m in (BUDGET, FORECAST)],
        F.map_from_entries(F.collect_list(F.struct("day", hours.alias("hours")))).alias("hours_on"),
    )


# --- allocation -----------------------------------------------------------------------------------


def month_periods(shutdown: DataFrame) -> DataFrame:
    """Shutdown hours per version and calendar month, see :func:`_shutdown_periods`."""
    return _shutdown_periods(shutdown, F.trunc("day", "MM"))


def rates(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Add the hourly rate of each measure, from its total and the shutdown hours of the period."""
    hours = ((F.datediff(last, first) + 1) * HOURS_PER_DAY).cast(_HOURS)
    added = {}
    for m in (BUDGET, FORECAST):
        left = hours - F.col(f"{m}_shutdown")
        working = F.greatest(left, F.lit(MIN_WORKING_HOURS).cast(_HOURS)).cast(_HOURS)
        rate = r.half_even(F.col(f"{m}_total") / working, PLAN_DIGITS).cast(_RATE)
        added[f"{m}_rate"] = F.when(F.col(f"{m}_total") > 0, rate).otherwise(F.lit(0).cast(_RATE))
    return df.withColumns(added)


def day_value(measure: str) -> Column:
    """Plan of ``day``: its hours net of shutdown (``hours_on``) times the rate."""
    return F.expr(
        f"CAST(bround(CAST(greatest({HOURS_PER_DAY} - coalesce(try_element_at(hours_on, day).{measure}_hours, 0BD), 0BD) "
        f"AS {_HOURS}) * {measure}_rate, {PLAN_DIGITS}) AS {_TOTAL})"
    )


def _rated(totals: DataFrame, periods: DataFrame, first: Column, last: Column) -> DataFrame:
    """Slices with a defined plan, with their rates and the shutdown hours of their days."""
    defined = totals.where((F.col(f"{BUDGET}_total") != 0) | (F.col(f"{FORECAST}_total") != 0))
    return rates(defined.join(periods, ["version", "period"]), first, last)


def _open_days(
    totals: DataFrame, periods: DataFrame, first: Column, last: Column, by: Sequence[str]
) -> DataFrame:
    """Totals per period and slice to one value per day, net of shutdown hours."""
    opened = cal.each_day(_rated(totals, periods, first, last), first, last)
    return opened.select("version", "day", *by, *[day_value(m).alias(m) for m in (BUDGET, FORECAST)])


def month_rates(
    plan: DataFrame, shutdown: DataFrame, materials: DataFrame, version: str, month: cal.DateLike
) -> DataFrame:
    """Rates and shutdown hours of one version and month over all materials: one row, or none
    if the plan of that month is not defined."""
    first, last = F.lit(cal.month_of(month)), F.lit(cal.end_of_month(month))
    month_plan = in_version(plan, version).where(F.col("month") == first)
    month_down = in_version(shutdown, version).where(F.col("day").between(first, last))
    totals = full_month_totals(monthly_slices(monthly_plan(month_plan), materials))
    periods = F.broadcast(month_periods(month_down))
    return _rated(totals.withColumnRenamed("month", "period"), periods, first, last)


def allocate_months(
    plan: DataFrame,
    shutdown: DataFrame,
    materials: DataFrame,
    by: Sequence[str] = (),
    version: str | None = None,
    month: cal.DateLike | None = None,
) -> DataFrame:
    """Daily plan of every version and month (or of the given ones), per slice ``by``.

    A month without any shutdown row, or a slice whose two totals are 0, has no days.
    """
    plan, shutdown = in_version(plan, version), in_version(shutdown, version)
    if month is not None:
        plan = plan.where(F.col("month") == F.lit(cal.month_of(month)))
        shutdown = shutdown.where(
            F.col("day").between(F.lit(cal.month_of(month)), F.lit(cal.end_of_month(month)))
        )
    slices = plan_slices(plan, materials, by)
    return allocate_slices(slices, shutdown, by, version)


def allocate_slices(
    slices: DataFrame, shutdown: DataFrame, by: Sequence[str] = (), version: str | None = None
) -> DataFrame:
    """As :func:`allocate_months`, from monthly values already summed to their slice.

    The periods of one version are twelve rows a year and are broadcast; those of all versions
    are left to adaptive execution, which broadcasts them while they are small and splits a
    month that holds most slices otherwise.
    """
    totals = full_month_totals(slices).withColumnRenamed("month", "period")
    periods = month_periods(shutdown)
    if version is not None:
        periods = F.broadcast(periods)
    return _open_days(totals, periods, F.col("period"), F.last_day("period"), by)


def allocate_interval(
    plan: DataFrame,
    shutdown: DataFrame,
    materials: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    version: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Daily plan of one interval taken as a whole; without a version all versions are pooled."""
    if version is None:
        plan, shutdown = pool_versions(plan), pool_versions(shutdown)
    plan = in_months(in_version(plan, version), start, end)
    shutdown = in_version(shutdown, version).where(
        F.col("day").between(cal.date_lit(start), cal.date_lit(end))
    )
    slices = monthly_slices(monthly_plan(plan), materials, by)
    first, last = cal.date_lit(start), cal.date_lit(end)
    totals = prorated_totals(slices, start, end, by).withColumn("period", first)
    # One version, one period: a single row.
    periods = F.broadcast(_shutdown_periods(shutdown, first))
    return _open_days(totals, periods, first, last, by)
