"""The reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.catalog import sql as q
from planact.catalog.actual_queries import history
from planact.catalog.core import plain, query
from planact.operators import actuals, telemetry
from planact.plans import category_sums, combined, daily_report, legacy_report, material_report, stored_history
from planact.session import scratch_path, stage
from planact.sinks import tables as sink
from planact.sources import star_views as sv

START, END, VERSION = "1998-01-01", "1998-01-31", "V0"

_IN_MONTH = f"between date '{START}' and date '{END}'"


@query(
    "telemetry_by_production_day",
    q.with_(q.TELEMETRY, q.PLANT)
    + f"select {q.DAY}, "
    + ", ".join(f"cast({c} as double) {c}" for c in telemetry.SUMMED)
    + " from v_plant",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.by_production_day(sv.telemetry(spark, sf))


@query(
    "plant_figures",
    q.with_(q.TELEMETRY, q.PLANT)
    + f"select {q.DAY}, cast({q.average('run_flag', 100)} as double) / 100 availability_pct, "
    f"cast({q.average('feed')} as double) / 100 avg_feed, cast({q.average('slag')} as double) / 100 pb_in_slag, "
    "cast(dust_set + dust_out + coal as double) returned_dust from v_plant",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.day_figures(telemetry.by_production_day(sv.telemetry(spark, sf)))


# --- daily report -----------------------------------------------------------------------------


def _hundredths_to(n: str, digits: int) -> str:
    """Hundredths rounded half-even to ``digits``, as DOUBLE."""
    unit = 10 ** (2 - digits)
    return f"cast({q.half_even(n, str(unit))} as double) / {10 ** digits}"


_BASE = "v_base as (select day from v_plant)"

# Observed days with actuals and plant figures, before the plan joins in.
_OBSERVED = (
    "v_observed as (select p.day, actual, "
    + ", ".join(f"cast({n}_tenths as double) / 10 {n}_pct" for n in q.SHARES)
    + f", {_hundredths_to('cast((dust_set + dust_out + coal) * 100 as hugeint) + recirculates * 100', 0)} recirculates, "
    f"fluxes, {_hundredths_to(q.average('run_flag', 100), 1)} availability_pct, "
    f"{_hundredths_to(q.average('feed'), 0)} avg_feed, {_hundredths_to(q.average('slag'), 1)} pb_in_slag "
    "from v_plant p join v_measures m on m.day = p.day)"
)

_SEEN = ("actual", *[f"{n}_pct" for n in q.SHARES], "recirculates", "fluxes", "availability_pct", "avg_feed", "pb_in_slag")


def _columns(key: str) -> str:
    seen = ", ".join(f"cast(coalesce({c}, 0) as double) {c}" for c in _SEEN)
    thousand = "cast(1000 as hugeint)"
    planned = ", ".join(
        f"cast({q.half_even(f'{m[0]}_milli', thousand)} as double) {m}" for m in ("forecast", "budget")
    )
    return f"{key}, {planned}, {seen}"


_DAILY_PARTS = (
    q.MATERIAL, q.MOVEMENT, q.PLAN, q.SHUTDOWN, q.TELEMETRY, q.PLANT, _BASE, q.MEASURES, q.SLICE_ALL,
    q.allocation(""), _OBSERVED,
)

_REPORT = q.with_(
    *_DAILY_PARTS,
    f"v_d as (select * from v_daily where version = '{VERSION}' and day {_IN_MONTH})",
    f"v_o as (select * from v_observed where day {_IN_MONTH})",
    "v_report as (select " + _columns("coalesce(v_d.day, v_o.day) as day")
    + ", case when v_o.day is null then 0 else 1 end has_telemetry "
    "from v_d full outer join v_o on v_o.day = v_d.day where exists (select 1 from v_d))",
)


_DAILY_REPORT = _REPORT + "select strftime(day, '%Y-%m-%d') as day, forecast, budget, " + ", ".join(_SEEN) + " from v_report"


@query("daily_report", _DAILY_REPORT)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return daily_report.daily_report(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION)


def _text(c: str, digits: int = 0) -> str:
    kind = f"decimal(30,{digits})" if digits else "bigint"
    return f"cast(cast({c} as {kind}) as varchar)"


def _percent(c: str, known: str) -> str:
    return f"case when {known} then {_text(c, 1)} || ' %' else '0 %' end"


_T = daily_report.TITLES
_MOVED = "has_telemetry = 1 and actual > 0"


@query(
    "daily_report_text",
    _REPORT
    + f"""select strftime(day, '%Y-%m-%d') "{_T['day']}", """
    + ", ".join(
        f'{_text(c)} "{_T[c]}"' for c in ("forecast", "budget", "actual", "recirculates", "fluxes", "avg_feed")
    )
    + ", "
    + ", ".join(f"""{_percent(f'{n}_pct', _MOVED)} "{_T[f'{n}_pct']}" """ for n in q.SHARES)
    + f""", {_percent('availability_pct', 'has_telemetry = 1')} "{_T['availability_pct']}",
{_percent('pb_in_slag', 'has_telemetry = 1')} "{_T['pb_in_slag']}" from v_report""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return daily_report.render(daily_report.daily_numbers(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION))


_HISTORY = (
    q.with_(*_DAILY_PARTS)
    + "select " + _columns("version, strftime(v_daily.day, '%Y-%m-%d') as day")
    + " from v_daily left join v_observed o on o.day = v_daily.day"
)


@query("daily_report_history", _HISTORY)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return daily_report.daily_history(sv.inputs(spark, sf))


# --- category sums --------------------------------------------------------------------------------

_LABEL_SLICE = (
    "v_slice as (select version, month, label, sum(budget) budget, sum(forecast) forecast "
    "from v_plan join v_plan_label using (material_id) group by 1, 2, 3)"
)

_SUM_PARTS = (
    q.MATERIAL, q.MOVEMENT, q.PLAN, q.SHUTDOWN, q.label_members("plan"), q.label_members("actual"), q.LABEL_NAMES,
    _LABEL_SLICE, q.allocation("label,"), q.RAW_BY_MATERIAL,
)


_CATEGORY_SUMS = (
    q.with_(
        *_SUM_PARTS,
        f"v_p as (select label, sum(b_milli) b, sum(f_milli) f from v_daily where version = '{VERSION}' "
        f"and day {_IN_MONTH} group by 1)",
        f"v_a as (select label, sum(t) t from v_raw join v_actual_label using (material_id) where day {_IN_MONTH} "
        "group by 1)",
    )
    + f"""select label, {q.milli("coalesce(b, 0)")} total_budget, {q.milli("coalesce(f, 0)")} total_forecast,
cast(case when b is null then 0 else coalesce(t, 0) end as double) total_actual
from v_label left join v_p using (label) left join v_a using (label)"""
)


@query("category_sums", _CATEGORY_SUMS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return category_sums.category_sums(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION)


_SUMS_HISTORY = (
    q.with_(
        *_SUM_PARTS,
        "v_p as (select version, cast(date_trunc('month', day) as date) as month, label, sum(b_milli) b, "
        "sum(f_milli) f from v_daily group by 1, 2, 3)",
        "v_a as (select cast(date_trunc('month', day) as date) as month, label, sum(t) t from v_raw "
        "join v_actual_label using (material_id) group by 1, 2)",
        "v_k as (select version, month, label from (select distinct version, month from v_p) cross join v_label)",
    )
    + f"""select version, strftime(month, '%Y-%m-%d') as month, label, {q.milli("coalesce(b, 0)")} total_budget,
{q.milli("coalesce(f, 0)")} total_forecast, cast(case when b is null then 0 else coalesce(t, 0) end as double) total_actual
from v_k left join v_p using (version, month, label) left join v_a using (month, label)"""
)


@query("category_sums_history", _SUMS_HISTORY)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return category_sums.category_sums_history(sv.inputs(spark, sf))


# --- stored history ---------------------------------------------------------------------------------


def _kept_up(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A stored report made before the movements of one month came, and that month made again when they did."""
    base, data = scratch_path(spark, "history"), sv.inputs(spark, sf)
    # The plan is a stored table, as in production: noting its months and both refreshes read it.
    data = replace(data, plan=stage(data.plan, "history-plan"))
    late = F.col("day").between(F.lit("1998-01-01").cast("date"), F.lit("1998-01-31").cast("date"))
    reports = {name: stored_history.REPORTS[name]}
    stored_history.note_changes(data.plan.select(F.col("month").alias("day")), f"{base}/changes")
    stored_history.refresh(spark, replace(data, movements=data.movements.where(~late)), f"{base}/changes", base, reports)
    stored_history.note_changes(data.movements.where(late), f"{base}/changes")
    stored_history.refresh(spark, data, f"{base}/changes", base, reports)
    return spark.read.parquet(f"{base}/{name}").drop(sink.MONTH)


@query("stored_daily_history", _HISTORY)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _kept_up(spark, sf, "daily")


@query("stored_category_sums", _SUMS_HISTORY)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _kept_up(spark, sf, "category_sums")


# --- per material ------------------------------------------------------------------------------------

_MATERIAL_REPORT = (
    q.with_(
        q.MATERIAL, q.MOVEMENT, q.PLAN, q.SHUTDOWN, q.calendar(START, END),
        f"v_slice as (select version, month, material_id, budget, forecast from v_plan join v_material "
        f"using (material_id) where version = '{VERSION}' and month = date '{START}')",
        q.allocation("material_id,"), q.RAW_BY_MATERIAL,
    )
    + f"""select strftime(d.day, '%Y-%m-%d') as day, m.material_name, m.material_id, m.material_type, m.category,
{q.milli("coalesce(b_milli, 0)")} budget, {q.milli("coalesce(f_milli, 0)")} forecast,
cast(coalesce(t, 0) as double) actual
from v_material m cross join v_days d
left join v_daily p on p.day = d.day and p.material_id = m.material_id
left join v_raw r on r.day = d.day and r.material_id = m.material_id"""
)


@query("material_report", _MATERIAL_REPORT)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return material_report.material_report(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION)


_PARTS = {
    "report": (_DAILY_REPORT, "day"),
    "category_sums": (_CATEGORY_SUMS, "label"),
    "report_per_material": (_MATERIAL_REPORT, "day, material_name, material_id, material_type, category"),
}


def _long_sql(part: str, text: str, keys: str) -> str:
    joined = " || '|' || ".join(keys.split(", "))
    numbers = f"select {joined} as key, columns(* exclude ({keys}))::double from ({text})"
    return (
        f"select '{part}' part, key, measure, number, cast(null as varchar) as text from "
        f"({numbers}) unpivot include nulls (number for measure in (columns(* exclude key)))"
    )


_PARAMS = {"Start Date:": f"{START} 00:00", "End Date:": f"{END} 23:59", "Version Name:": VERSION}


@query(
    "combined_report_written",
    " union all ".join(
        [_long_sql(name, *part) for name, part in _PARTS.items()]
        + [f"select '{name}_params', '{k}', 'value', null, '{v}'" for name in _PARTS for k, v in _PARAMS.items()]
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All parts and their parameter blocks written to a report folder and read back, a row per number or text."""
    folder = scratch_path(spark, "reports")
    written = combined.write_combined_report(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION, folder)
    rows = None
    for name, (_, keys) in _PARTS.items():
        part = plain(spark.read.parquet(written[name]))
        ids = keys.split(", ")
        numbers = [F.col(c).cast("double").alias(c) for c in part.columns if c not in ids]
        long = part.select(F.concat_ws("|", *ids).alias("key"), *numbers).unpivot(
            "key", [c for c in part.columns if c not in ids], "measure", "number"
        )
        params = spark.read.parquet(f"{written[name]}_params").select(
            F.lit(f"{name}_params").alias("part"), F.col("description").alias("key"), F.lit("value").alias("measure"),
            F.lit(None).cast("double").alias("number"), F.col("value").alias("text"),
        )
        long = long.select(F.lit(name).alias("part"), "*", F.lit(None).cast("string").alias("text")).unionByName(params)
        rows = long if rows is None else rows.unionByName(long)
    return rows


# --- older report table ----------------------------------------------------------------------------------


def legacy() -> str:
    """Text rows of all days of the movements as v_legacy."""
    moved = "actual > 0"
    pct = ", ".join(
        f"case when {moved} then cast(cast(cast({n}_tenths as double) / 10 as decimal(30,1)) as varchar) || ' %' "
        f"else '0 %' end {n}"
        for n in q.SHARES
    )
    return ",\n".join(
        [
            q.MATERIAL, q.MOVEMENT, q.HISTORY, "v_base as (select day from v_days)", q.MEASURES,
            f"v_legacy as (select strftime(day, '%Y-%m-%d') monthday, {_text('actual')} || ' t' actual, {pct}, "
            f"{_text('fluxes')} || ' t' fluxes from v_measures)",
        ]
    )


@query("legacy_report", q.with_(legacy()) + "select * from v_legacy")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_report.legacy_rows(sv.inputs(spark, sf), *history(spark, sf))


@query(
    "actual_days_complete",
    q.with_(*_DAILY_PARTS, q.calendar(START, END),
            q.MEASURES.replace("v_", "w_").replace("w_movement", "v_movement").replace("w_material", "v_material")
            .replace("w_base", "v_days"))
    + "select strftime(d.day, '%Y-%m-%d') as day, cast(actual as double) actual, "
    + ", ".join(f"cast({n}_tenths as double) / 10 {n}_pct" for n in q.SHARES)
    + ", cast(fluxes as double) fluxes from w_measures d",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The daily report with every day of the interval shown, the actual side of it."""
    numbers = daily_report.daily_numbers(sv.inputs(spark, sf, (START, END), VERSION), START, END, VERSION, complete_days=True)
    return numbers.select("day", "actual", *daily_report.SHARES, "fluxes")


@query(
    "report_days_of_movement",
    q.with_(q.MOVEMENT, q.MOVED_DAYS) + "select strftime(day, '%Y-%m') as month, count(*) as days from v_moved group by 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """How many days per month have anything to report."""
    mass = actuals.day_material_mass(sv.movements(spark, sf))
    return mass.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count_distinct("day").alias("days"))
