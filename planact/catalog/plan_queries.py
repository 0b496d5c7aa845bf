"""Plan, shutdown hours and the daily allocation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.catalog import sql as q
from planact.catalog.core import query
from planact.functions import dates
from planact.operators import calendar as cal
from planact.operators import plan
from planact.sources import star_views as sv


@query(
    "plan_monthly",
    q.with_(q.PLAN)
    + "select version, material_id, strftime(month, '%Y-%m-%d') as month, cast(budget as double) budget, "
    "cast(forecast as double) forecast from v_plan",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.monthly_plan(sv.plan(spark, sf))


# The months of the plan in the test tables, as the SQL side names its columns.
_MONTHS = [dt.date(y, m, 1) for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8)]


def _cell(measure: str, month: dt.date) -> str:
    name = plan.MEASURE_PREFIX[measure] + month.strftime("%b_%y").lower()
    return f"cast(sum(case when month = date '{month}' then {measure} end) as double) {name}"


@query(
    "plan_wide",
    q.with_(q.PLAN)
    + "select version, material_id, "
    + ", ".join(_cell(measure, month) for measure in ("budget", "forecast") for month in _MONTHS)
    + " from v_plan group by 1, 2",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.pivot_months(sv.plan(spark, sf), ["version", "material_id"])


@query(
    "plan_unpivoted",
    q.with_(q.PLAN, q.PLAN_LONG)
    + """select version, strftime(m.month, '%Y-%m-%d') as month, m.measure, count(*) cells,
cast(sum(coalesce(value, 0)) as double) as value
from (select distinct version, material_id from v_plan) k
cross join (select distinct month, measure from v_plan_long) m
left join v_plan_long p using (version, material_id, month, measure) group by 1, 2, 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Back from the wide layout: every cell is a row again, empty ones as 0."""
    ids = ["version", "material_id"]
    wide = plan.pivot_months(_short_years(sv.plan(spark, sf)), ids)
    long = plan.unpivot_months(wide, ids)
    return (
        long.withColumn("month", F.add_months("month", -12 * _YEARS_AHEAD))
        .groupBy("version", "month", "measure")
        .agg(F.count("*").alias("cells"), F.sum("value").alias("value"))
    )


# Labels hold two digits of the year, read as 20yy; the test months are moved there and back.
_YEARS_AHEAD = 20


def _short_years(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.add_months("month", 12 * _YEARS_AHEAD))


@query(
    "plan_month_labels",
    q.with_(q.PLAN)
    + """select strftime(month, '%Y-%m-%d') as month, lower(strftime(month, '%b_%y')) label,
strftime(month, '%Y-%m-%d') parsed, year(month) as year, quarter(month) as quarter, day(last_day(month)) as days,
count(*) cells from v_plan group by month""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    months = sv.plan(spark, sf).where("measure = 'budget'").groupBy("month").agg(F.count("*").alias("cells"))
    moved = F.add_months("month", 12 * _YEARS_AHEAD)
    return months.select(
        "month",
        dates.month_label(F.col("month")).alias("label"),
        F.add_months(dates.month_from_label(dates.month_label(moved)), -12 * _YEARS_AHEAD).alias("parsed"),
        F.year("month").alias("year"),
        F.quarter("month").alias("quarter"),
        dates.days_in_month(F.col("month")).alias("days"),
        "cells",
    )


@query(
    "plan_by_month_label",
    q.with_(q.PLAN, q.PLAN_LONG)
    + """select material_id, measure, lower(strftime(month, '%b_%y')) label, cast(sum(value) as double) as value
from v_plan_long group by 1, 2, 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    nested = plan.plan_by_month_map(sv.plan(spark, sf))
    return nested.select("material_id", "measure", F.explode("by_month").alias("label", "value"))


# --- proration over intervals ---------------------------------------------------------------


def _prorated(start: str, end: str, versions: str, keys: str) -> str:
    """Totals in thousandths per version expression and keys; ``end`` lies in the last month."""
    seconds = (
        f"case when p.month = date_trunc('month', timestamp '{end}') then "
        f"date_diff('second', cast(p.month as timestamp), timestamp '{end}') "
        "else day(last_day(p.month)) * 86400 - 1 end"
    )
    whole = "(day(last_day(p.month)) * 86400)"

    def total(m: str) -> str:
        # half-up at ten digits per month, half-even at three on the sum
        n = f"cast({m} * 100 as hugeint) * {seconds} * 100000000"
        return f"(2 * ({n}) + {whole}) // (2 * {whole})"

    more = f", {keys}" if keys else ""
    return f"""v_month as (
select {versions} as version, month{more}, sum(budget) budget, sum(forecast) forecast
from v_plan join v_material using (material_id)
where cast(month as timestamp) between timestamp '{start}' and timestamp '{end}' group by all),
v_spread as (select version{more}, {total("budget")} b, {total("forecast")} f from v_month p),
v_prorated as (
select version{more}, {q.half_even("cast(sum(b) as hugeint)", "cast(10000000 as hugeint)")} budget_total,
{q.half_even("cast(sum(f) as hugeint)", "cast(10000000 as hugeint)")} forecast_total from v_spread group by all)"""


_START, _END = dt.datetime(1995, 1, 15, 0, 0), dt.datetime(2001, 8, 20, 12, 0)


@query(
    "plan_interval_totals",
    q.with_(q.MATERIAL, q.PLAN, _prorated(str(_START), str(_END), "version", "category"))
    + f"select version, category, {q.milli('budget_total')} budget_total, {q.milli('forecast_total')} forecast_total "
    "from v_prorated",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """An interval that starts and ends within a month, per version and category."""
    slices = plan.monthly_slices(
        plan.monthly_plan(plan.in_months(sv.plan(spark, sf), _START, _END)), sv.materials(spark, sf), ["category"]
    )
    return plan.prorated_totals(slices, _START, _END, ["category"])


# --- shutdown hours -----------------------------------------------------------------------------


@query(
    "shutdown_days",
    q.with_(q.SHUTDOWN)
    + f"select version, {q.DAY}, cast(b_hours as double) budget_hours, cast(f_hours as double) forecast_hours "
    "from v_shutdown where b_hours > 0 or f_hours > 0",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.shutdown_by_day(sv.shutdown(spark, sf))


@query(
    "shutdown_between",
    q.with_(q.SHUTDOWN)
    + f"select version, {q.DAY}, cast(b_hours as double) budget_hours, cast(f_hours as double) forecast_hours "
    "from v_shutdown where (b_hours > 0 or f_hours > 0) and day between date '1998-01-01' and date '1998-12-31' "
    "and version = 'V1'",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.shutdown_between(sv.shutdown(spark, sf), "1998-01-01", "1998-12-31", "V1")


@query(
    "shutdown_totals",
    q.with_(q.SHUTDOWN)
    + "select version, cast(sum(b_hours) as double) budget_hours, cast(sum(f_hours) as double) forecast_hours "
    "from v_shutdown group by 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.shutdown_totals(sv.shutdown(spark, sf))


@query(
    "shutdown_on_calendar",
    q.with_(q.MOVEMENT, q.SHUTDOWN, q.SHUTDOWN_LONG)
    + f"select version, {q.DAY}, measure, hours from v_shutdown_long "
    "where hours > 0 and day in (select day from v_movement)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Joined with a calendar that knows the days of the movements."""
    dim_time = cal.day_members(sv.movements(spark, sf))
    return plan.shutdown_on_calendar(sv.shutdown(spark, sf), dim_time).select("version", "day", "measure", "hours")


# --- allocation -------------------------------------------------------------------------------------


def _daily(slices: str, keys: str) -> str:
    return (
        q.with_(q.MATERIAL, q.PLAN, q.SHUTDOWN, slices, q.allocation(f"{keys}," if keys else ""))
        + f"select version, {q.DAY}, {keys + ', ' if keys else ''}{q.milli('b_milli')} budget, "
        f"{q.milli('f_milli')} forecast from v_daily"
    )


@query("plan_daily", _daily(q.SLICE_ALL, ""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.allocate_months(sv.plan(spark, sf), sv.shutdown(spark, sf), sv.materials(spark, sf))


@query("plan_daily_by_category", _daily(q.slice_by("category"), "category"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.allocate_months(
        sv.plan(spark, sf), sv.shutdown(spark, sf), sv.materials(spark, sf), by=["category"]
    )


@query("plan_daily_by_type", _daily(q.slice_by("material_type"), "material_type"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plan.allocate_months(
        sv.plan(spark, sf), sv.shutdown(spark, sf), sv.materials(spark, sf), by=["material_type"]
    )


_QUARTER = dt.datetime(1998, 1, 1, 0, 0), dt.datetime(1998, 3, 31, 23, 59)
_HOURS = 90 * 24


def _interval_rate(m: str) -> str:
    return q.half_even(f"{m}_total", f"greatest({_HOURS} - (select sum({m[0]}_hours) from v_off), 3)")


@query(
    "plan_daily_interval",
    q.with_(
        q.MATERIAL,
        q.PLAN,
        q.SHUTDOWN,
        q.calendar("1998-01-01", "1998-03-31"),
        _prorated(str(_QUARTER[0]), str(_QUARTER[1]), "'*'", ""),
        "v_off as (select day, cast(sum(b_hours) as hugeint) b_hours, cast(sum(f_hours) as hugeint) f_hours "
        "from v_shutdown where day between date '1998-01-01' and date '1998-03-31' group by 1)",
    )
    + f"""select version, strftime(d.day, '%Y-%m-%d') as day,
{q.milli(f"greatest(24 - coalesce(b_hours, 0), 0) * {_interval_rate('budget')}")} budget,
{q.milli(f"greatest(24 - coalesce(f_hours, 0), 0) * {_interval_rate('forecast')}")} forecast
from v_prorated cross join v_days d left join v_off o on o.day = d.day""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One quarter as one period, all versions pooled."""
    return plan.allocate_interval(
        sv.plan(spark, sf), sv.shutdown(spark, sf), sv.materials(spark, sf), *_QUARTER
    )
