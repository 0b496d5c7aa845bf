"""Change detection, upserts, duplicates and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact import schemas
from planact.catalog import sql as q
from planact.catalog.actual_queries import history
from planact.catalog.core import query
from planact.catalog.report_queries import legacy
from planact.operators import calendar as cal
from planact.operators import change, dedupe, quality, state
from planact.plans import legacy_report, plan_load, plan_state
from planact.session import scratch_path, stage
from planact.sinks import tables as sink
from planact.sources import star_views as sv

# V0 and V2 are stored, V1 arrives; V2 was loaded last.
_STORED = ("V0", "V2")
_NEW = "V1"
_STORED_SQL = "v_store as (select * from v_plan_long where version in ('V0', 'V2'))"
_NEW_SQL = "v_new as (select * from v_plan_long where version = 'V1')"
_LATEST_SQL = (
    "v_latest as (select material_id, month, measure, arg_max(value, inserted_at) as value from v_store group by 1, 2, 3)"
)
_LATEST_VERSION_SQL = (
    "v_latest_version as (select material_id, measure, arg_max(version, inserted_at) as version from v_store group by 1, 2)"
)


def _plan(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    facts = sv.plan(spark, sf)
    return facts.where(F.col("version") == _NEW), facts.where(F.col("version").isin(*_STORED))


def _shutdown(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    facts = sv.shutdown(spark, sf)
    return facts.where(F.col("version") == _NEW), facts.where(F.col("version").isin(*_STORED))


@query(
    "latest_values",
    q.with_(q.PLAN, q.PLAN_LONG, "v_store as (select * from v_plan_long)", _LATEST_SQL)
    + "select material_id, strftime(month, '%Y-%m-%d') as month, measure, cast(value as double) as value from v_latest",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return change.latest_values(sv.plan(spark, sf))


@query(
    "latest_versions",
    q.with_(q.PLAN, q.PLAN_LONG, "v_store as (select * from v_plan_long)", _LATEST_VERSION_SQL)
    + "select material_id, measure, version from v_latest_version",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return change.latest_versions(sv.plan(spark, sf))


@query("versions", q.with_(q.PLAN) + "select distinct version from v_plan")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return change.versions(sv.plan(spark, sf))


@query("materials_in_plan", q.with_(q.PLAN) + "select distinct material_id from v_plan")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return change.materials_in_plan(sv.plan(spark, sf))


@query(
    "new_materials",
    q.with_(q.PLAN)
    + "select distinct material_id from v_plan where version = 'V1' and material_id not in "
    "(select material_id from v_plan where version = 'V0' and month < date '1996-01-01')",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Against a store that holds the first year of one version."""
    facts = sv.plan(spark, sf)
    stored = facts.where((F.col("version") == "V0") & (F.col("month") < F.lit("1996-01-01").cast("date")))
    return change.new_materials(facts.where(F.col("version") == _NEW), stored)


@query(
    "changed_versions",
    q.with_(q.PLAN, q.PLAN_LONG, _STORED_SQL, _NEW_SQL, _LATEST_VERSION_SQL)
    + """select distinct n.material_id, n.measure, n.version, s.version stored_version
from v_new n left join v_latest_version s on s.material_id = n.material_id and s.measure = n.measure
where n.version is distinct from s.version""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    new, stored = _plan(spark, sf)
    return change.changed_versions(new, stored)


_CHANGED = """not (coalesce({old}, 0) = 0 and coalesce({new}, 0) = 0) and ({old} is null or {new} is null
or not (abs(cast({old} as double) - cast({new} as double))
        <= 1e-5 * greatest(abs(cast({old} as double)), abs(cast({new} as double)))))"""

_CELLS_SQL = (
    "v_cells as (select n.material_id, n.month, n.measure, s.value as stored_value, n.value as new_value "
    "from v_new n left join v_latest s on s.material_id = n.material_id and s.month = n.month and s.measure = n.measure "
    "where " + _CHANGED.format(old="s.value", new="n.value") + ")"
)


@query(
    "changed_cells",
    q.with_(q.PLAN, q.PLAN_LONG, _STORED_SQL, _NEW_SQL, _LATEST_SQL, _CELLS_SQL)
    + "select material_id, strftime(month, '%Y-%m-%d') as month, measure, cast(stored_value as double) stored_value, "
    "cast(new_value as double) new_value from v_cells",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    new, stored = _plan(spark, sf)
    return change.changed_cells(new, stored)


_DOWN_SQL = (
    "v_down as (select n.day, n.measure, s.hours stored_hours, n.hours new_hours from "
    "(select * from v_shutdown_long where version = 'V1') n left join "
    "(select day, measure, arg_max(hours, inserted_at) as hours from v_shutdown_long where version in ('V0', 'V2') "
    "group by 1, 2) s on s.day = n.day and s.measure = n.measure "
    "where s.hours is null or not (abs(s.hours - n.hours) <= 1e-5 * greatest(abs(s.hours), abs(n.hours))))"
)


@query(
    "changed_shutdown",
    q.with_(q.SHUTDOWN, q.SHUTDOWN_LONG, _DOWN_SQL) + f"select {q.DAY}, measure, stored_hours, new_hours from v_down",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    new, stored = _shutdown(spark, sf)
    return change.changed_shutdown(new, stored)


def _loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, plan_state.StateTables]:
    """Facts of all versions, written, and the state after the stored ones were merged load by load."""
    facts, down = stage(sv.plan(spark, sf), "facts"), stage(sv.shutdown(spark, sf), "shutdown")
    tables = plan_state.StateTables(scratch_path(spark, "plan-state"))
    for version in _STORED:
        mine = F.col("version") == version
        plan_state.merge(spark, tables, facts.where(mine), down.where(mine), [version])
    return facts, down, tables


@query(
    "plan_state",
    q.with_(q.PLAN, q.PLAN_LONG, _STORED_SQL)
    + """select material_id, strftime(month, '%Y-%m-%d') as month, measure, cast(arg_max(value, inserted_at) as double) as value,
arg_max(version, inserted_at) as version from v_store group by 1, 2, 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The maintained state: latest value and version of every cell after two loads."""
    _, _, tables = _loaded(spark, sf)
    return plan_state.read(spark, tables)[0].select("material_id", "month", "measure", "value", "version")


@query(
    "plan_digest_difference",
    q.with_(
        q.PLAN, q.PLAN_LONG, _STORED_SQL, _LATEST_SQL,
        "v_moved as (select material_id, month, measure, coalesce(value, 0) + case when month = date '1997-05-01' "
        "and measure = 'budget' then 1 else 0 end as value from v_latest)",
    )
    + """select strftime(month, '%Y-%m-%d') as month, measure from (
select n.month, n.measure, count(*) filter (where n.value is distinct from coalesce(s.value, 0)) as moved
from v_moved n left join v_latest s using (material_id, month, measure) group by 1, 2) where moved > 0""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook like the stored state but for one month of one measure: digests find that month."""
    _, _, tables = _loaded(spark, sf)
    now = plan_state.read(spark, tables)[0]
    here = (F.col("month") == F.lit("1997-05-01").cast("date")) & (F.col("measure") == "budget")
    moved = F.coalesce("value", F.lit(0)) + F.when(here, 1).otherwise(0)
    return plan_state.changed_months(spark, tables, now.withColumn("value", moved.cast("decimal(18,2)")))


@query(
    "load_decision",
    q.with_(
        q.PLAN, q.PLAN_LONG, q.SHUTDOWN, q.SHUTDOWN_LONG, _STORED_SQL, _NEW_SQL, _LATEST_SQL, _LATEST_VERSION_SQL,
        _CELLS_SQL, _DOWN_SQL,
    )
    + """select (select count(*) from v_new) new_cells, 0 version_in_use, 0 store_empty,
(select count(distinct material_id) from v_new where material_id not in (select material_id from v_store)) new_materials,
(select count(*) from (select distinct n.material_id, n.measure from v_new n left join v_latest_version s
 using (material_id, measure) where n.version is distinct from s.version)) changed_versions,
(select count(*) from v_cells where measure = 'budget') changed_budget_cells,
(select count(*) from v_cells where measure = 'forecast') changed_forecast_cells,
(select count(*) from v_down where measure = 'budget') changed_shutdown_days,
1 should_load""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Against the state of two stored versions; ``plan_state`` is the query that merges it load by load."""
    (new, stored), (new_down, stored_down) = _plan(spark, sf), _shutdown(spark, sf)
    plan, down = state.plan_state(stored), state.shutdown_state(stored_down)
    known = state.Known(frozenset(_STORED), False)
    return state.decision(new, new_down.where("measure = 'budget'"), plan, down, known).flags


@query(
    "load_refused",
    q.with_(q.PLAN, q.PLAN_LONG)
    + "select count(*) new_cells, 1 version_in_use, 0 should_load from v_plan_long where version = 'V2'",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A version that is stored already is refused, whatever has changed."""
    facts, down = stage(sv.plan(spark, sf), "facts"), stage(sv.shutdown(spark, sf), "shutdown")
    again, down_again = facts.where("version = 'V2'"), down.where("version = 'V2' and measure = 'budget'")
    flags = change.load_decision(again, down_again, facts, down).flags
    return flags.select("new_cells", "version_in_use", "should_load")


# --- loading facts --------------------------------------------------------------------------------


@query(
    "storable_plan_rows",
    q.with_(q.MATERIAL, q.MOVEMENT, q.PLAN, q.PLAN_LONG)
    + """select version, material_id, strftime(month, '%Y-%m-%d') as month, measure, cast(value as double) as value
from v_plan_long where material_id in (select material_id from v_material where material_type = 'Cons')
and month in (select date_trunc('month', day) from v_movement where cls = 'ROH')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Known materials (one type) and known months (those with raw material) only."""
    known = sv.materials(spark, sf).where("material_type = 'Cons'")
    dim_time = cal.month_members(sv.movements(spark, sf).where("cls = 'ROH'"), "day")
    return plan_load.plan_fact_rows(sv.plan(spark, sf), known, dim_time)


@query(
    "new_movements",
    q.with_(q.MOVEMENT, "v_stored as (select doc_id, day from v_movement where day < date '1998-07-01')")
    + f"""select doc_id, material_id, {q.DAY}, cls, place, cast(kg as double) kg from v_movement m
where not exists (select 1 from v_stored s where s.doc_id = m.doc_id and s.day = m.day)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = sv.movements(spark, sf)
    stored = rows.where(F.col("day") < F.lit("1998-07-01").cast("date"))
    return dedupe.new_movements(rows, stored).select("doc_id", "material_id", "day", "cls", "place", "kg")


# --- upserts ----------------------------------------------------------------------------------------

_SOURCE_SQL = """v_source as (
select cast(p_partkey as varchar) material_id, concat(p_brand, ' ', p_name) material_name, 'Others' material_type,
       'RE' category from part where p_retailprice > (select avg(p_retailprice) from part)
union all select concat('S', cast(s_suppkey as varchar)), s_name, 'Cons', 'H' from supplier)"""


def _material_changes(spark: SparkSession, sf: str) -> DataFrame:
    part = sv.table(spark, sf, "part")
    dear = part.where(F.col("p_retailprice") > part.agg(F.avg("p_retailprice")).scalar()).select(
        F.col("p_partkey").cast("string").alias("material_id"),
        F.concat_ws(" ", "p_brand", "p_name").alias("material_name"),
        F.lit("Others").alias("material_type"),
        F.lit("RE").alias("category"),
    )
    supplied = sv.table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("material_id"),
        F.col("s_name").alias("material_name"),
        F.lit("Cons").alias("material_type"),
        F.lit("H").alias("category"),
    )
    return dear.unionByName(supplied)


@query(
    "upserted_materials",
    q.with_(q.MATERIAL, _SOURCE_SQL)
    + """select coalesce(s.material_id, t.material_id) material_id,
case when s.material_id is null then t.material_name else s.material_name end material_name,
case when s.material_id is null then t.material_type else s.material_type end material_type,
case when s.material_id is null then t.category else s.category end category
from v_material t full outer join v_source s on s.material_id = t.material_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Written to a table twice, the second time over what the first left."""
    path = scratch_path(spark, "materials")
    sink.upsert_table(spark, path, schemas.MATERIAL, sv.materials(spark, sf), ["material_id"])
    sink.upsert_table(spark, path, schemas.MATERIAL, _material_changes(spark, sf), ["material_id"])
    return spark.read.schema(schemas.MATERIAL).parquet(path)


@query("upserted_report", q.with_(legacy()) + "select * from v_legacy")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The older report table: the first half of history stored with one month stale, that month and all later ones written over it."""
    data, (lo, hi) = sv.inputs(spark, sf), history(spark, sf)
    path = scratch_path(spark, "report")
    middle = cal.month_of(lo + (hi - lo) / 2)
    first = legacy_report.legacy_rows(data, lo, cal.end_of_month(middle)).withColumn(sink.MONTH, sink.month_of(legacy_report.KEY))
    second = legacy_report.legacy_rows(data, middle, hi).withColumn(sink.MONTH, sink.month_of(legacy_report.KEY))
    old = F.col(legacy_report.KEY) >= F.lit(middle)
    stale = first.select(
        legacy_report.KEY,
        *[F.when(old, "stale").otherwise(F.col(c)).alias(c) for c in first.columns[1:-1]],
        sink.MONTH,
    )
    schema = first.schema
    sink.upsert_partitions(spark, path, schema, stale, [legacy_report.KEY], sink.MONTH)
    sink.upsert_partitions(spark, path, schema, second, [legacy_report.KEY], sink.MONTH)
    return spark.read.schema(schema).parquet(path).drop(sink.MONTH)


@query(
    "last_row_wins",
    """select material_id, price, flag from (
select cast(l_partkey as varchar) material_id, l_extendedprice price, l_returnflag flag,
row_number() over (partition by l_partkey order by l_orderkey desc, l_linenumber desc, l_extendedprice desc,
l_returnflag desc) rn from lineitem) where rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = sv.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("material_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
        F.struct("l_orderkey", "l_linenumber").alias("position"),
    )
    return dedupe.last_row_wins(rows, ["material_id"], "position").select("material_id", "price", "flag")


@query(
    "distinct_rows",
    q.with_(q.MOVEMENT) + "select distinct material_id, cls, place from v_movement",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.distinct_rows(sv.movements(spark, sf).select("material_id", "cls", "place"))


# --- calendar ---------------------------------------------------------------------------------------------


@query(
    "time_members",
    q.with_(q.MOVEMENT, q.PLAN)
    + """select distinct year(month) as year, quarter(month) as quarter, month(month) as month, 0 as day, 1 is_month
from v_plan union all
select distinct year(day), quarter(day), month(day), day(day), 0 from v_movement""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Months of the plan and days of the movements, stored in two loads."""
    path = scratch_path(spark, "time")
    months = cal.month_members(sv.plan(spark, sf).where("measure = 'budget'"))
    days = cal.day_members(sv.movements(spark, sf))
    sink.append_missing_members(spark, path, months.unionByName(days.where("year < 1998")))
    sink.append_missing_members(spark, path, months.unionByName(days))
    return spark.read.schema(schemas.TIME_MEMBER).parquet(path)


@query(
    "time_member_dates",
    q.with_(q.MOVEMENT, q.PLAN)
    + """select 'day' grain, count(*) members, strftime(min(day), '%Y-%m-%d') first_day, strftime(max(day), '%Y-%m-%d') last_day
from (select distinct day from v_movement) union all
select 'month', count(distinct month), null, null from v_plan""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Day members have a date, month members (day 0) have none."""
    months = cal.month_members(sv.plan(spark, sf).where("measure = 'budget'"))
    members = cal.member_date(months.unionByName(cal.day_members(sv.movements(spark, sf))))
    grain = F.when(F.col("is_month"), "month").otherwise("day")
    return members.groupBy(grain.alias("grain")).agg(
        F.count("*").alias("members"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )


# --- checks --------------------------------------------------------------------------------------------------

# Categories with gaps: brands without a size class count as blank, cheap ones as missing.
_GAPS_SQL = """v_gaps as (
select case when p_size = 1 then null else cast(p_partkey as varchar) end material_id, p_name material_name,
case when p_retailprice < 1000 then null when p_type = 'MEDIUM' then '  ' else p_type end category from part)"""


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return sv.table(spark, sf, "part").select(
        F.when(F.col("p_size") != 1, F.col("p_partkey").cast("string")).alias("material_id"),
        F.col("p_name").alias("material_name"),
        F.when(F.col("p_retailprice") < 1000, F.lit(None))
        .when(F.col("p_type") == "MEDIUM", F.lit("  "))
        .otherwise(F.col("p_type"))
        .alias("category"),
    )


@query(
    "category_check",
    q.with_(_GAPS_SQL)
    + """select count(*) as rows, sum(case when category is null or trim(category) = '' then 1 else 0 end)::bigint bad_rows
from v_gaps where material_id is not null""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.category_summary(_gaps(spark, sf))


@query(
    "rows_without_category",
    q.with_(_GAPS_SQL)
    + """select material_id, material_name, category from v_gaps
where material_id is not null and (category is null or trim(category) = '')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.without_category(_gaps(spark, sf))


@query(
    "filled_columns",
    q.with_(q.TELEMETRY)
    + "select count(ts) ts, count(run_flag) run_flag, count(feed) feed, count(coal) coal, count(dust_set) dust_set, "
    "cast(0 as bigint) humidity, count(dust_out) dust_out, count(slag) slag from v_telemetry",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.filled_columns(sv.telemetry(spark, sf))
