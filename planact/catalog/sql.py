"""Building blocks of the SQL counterparts.

The counterparts compute in DECIMAL and HUGEINT and round with ``round_even``, a different
route to the same numbers than the long arithmetic of the DataFrame side.
"""

from __future__ import annotations

from planact.operators.plan import MIN_WORKING_HOURS
from planact.plans.category_sums import LABELS

MATERIAL = """v_material as (
select cast(p_partkey as varchar) material_id,
       concat(p_name, ' ', cast(p_partkey as varchar)) material_name,
       case when p_type in ('ECONOMY','STANDARD','SMALL') then 'Cons'
            when p_type = 'MEDIUM' then 'Paste' else 'Others' end material_type,
       case when p_type in ('ECONOMY','STANDARD','SMALL')
              then case p_size % 3 when 0 then 'H' when 1 then 'N' else 'PK' end
            when p_type = 'MEDIUM' then 'P'
            else case p_size % 3 when 0 then 'Ox' when 1 then 'RI' else 'RE' end end category
from part)"""

MOVEMENT = """v_movement as (
select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) doc_id,
       cast(l_partkey as varchar) material_id, concat('M', cast(l_partkey as varchar)) label,
       cast(l_shipdate as date) as day,
       case l_returnflag when 'R' then 'ROH' when 'A' then 'KRSM' else 'HIBE' end cls,
       case l_suppkey % 3 when 0 then 55 when 1 then 53 else 51 end place,
       cast(-l_quantity * 137 as decimal(18,3)) kg
from lineitem)"""

PLAN = """v_plan as (
select version, material_id, month, cast(b as decimal(18,2)) budget, cast(f as decimal(18,2)) forecast from (
select concat('V', cast(o_orderkey % 3 as varchar)) as version, cast(l_partkey as varchar) material_id,
       cast(date_trunc('month', o_orderdate) as date) as month,
       sum(cast(l_extendedprice as decimal(18,2))) b,
       sum(cast(l_extendedprice as decimal(18,2)) * cast(1 - l_discount as decimal(4,2))) f
from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3))"""

SHUTDOWN = """v_shutdown as (
select concat('V', cast(o_orderkey % 3 as varchar)) as version, cast(o_orderdate as date) as day,
       least(cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as int) * 4, 24) b_hours,
       least(cast(sum(case when o_orderstatus = 'P' then 1 else 0 end) as int) * 4, 24) f_hours
from orders group by 1, 2)"""

TELEMETRY = """v_telemetry as (
select ts - INTERVAL '26' YEAR as ts, case when event_type = 'error' then 0 else 1 end run_flag,
       cast(value as decimal(10,2)) feed,
       case when event_type = 'click'    then cast(value as decimal(10,2)) end dust_set,
       case when event_type = 'view'     then cast(value as decimal(10,2)) end dust_out,
       case when event_type = 'purchase' then cast(value as decimal(10,2)) end coal,
       case when event_type = 'signup'   then cast(value as decimal(10,2)) end slag
from events)"""

PLAN_LONG = """v_plan_long as (
select version, material_id, month, 'budget' measure, budget as value,
       case version when 'V0' then timestamp '2024-01-01' when 'V1' then timestamp '2024-02-01'
            else timestamp '2024-03-01' end inserted_at from v_plan
union all
select version, material_id, month, 'forecast', forecast,
       case version when 'V0' then timestamp '2024-01-01' when 'V1' then timestamp '2024-02-01'
            else timestamp '2024-03-01' end from v_plan)"""

SHUTDOWN_LONG = """v_shutdown_long as (
select version, day, 'budget' measure, cast(b_hours as double) as hours,
       case version when 'V0' then timestamp '2024-01-01' when 'V1' then timestamp '2024-02-01'
            else timestamp '2024-03-01' end inserted_at from v_shutdown
union all
select version, day, 'forecast', cast(f_hours as double),
       case version when 'V0' then timestamp '2024-01-01' when 'V1' then timestamp '2024-02-01'
            else timestamp '2024-03-01' end from v_shutdown)"""

DAY = "strftime(day, '%Y-%m-%d') as day"


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def half_even(n: str, d: str) -> str:
    """Non-negative integer division rounded half-even."""
    n, d = f"({n})", f"({d})"
    return (
        f"({n} // {d} + case when 2 * ({n} % {d}) > {d} or (2 * ({n} % {d}) = {d} and ({n} // {d}) % 2 = 1) "
        "then 1 else 0 end)"
    )


def tons(kg_sum: str, digits: int) -> str:
    return f"round_even(cast({kg_sum} as decimal(24,3)) * 0.001, {digits})"


def abs_tons(kg_sum: str, digits: int) -> str:
    return f"abs({tons(kg_sum, digits)})"


def calendar(start: str, end: str) -> str:
    return (
        "v_days as (select cast(unnest(generate_series(timestamp "
        f"'{start}', timestamp '{end}', interval 1 day)) as date) as day)"
    )


# All days of the movements, from the first to the last.
HISTORY = (
    "v_days as (select cast(unnest(generate_series(cast(min(day) as timestamp), cast(max(day) as timestamp), interval 1 day)) "
    "as date) as day from v_movement)"
)

# Rounded tons per day and material, raw material of both places.
RAW_BY_MATERIAL = f"""v_raw as (
select day, material_id, {abs_tons("sum(kg)", 1)} t
from v_movement where cls = 'ROH' and place in (53, 55) group by 1, 2)"""

ACTUAL = f"""v_actual as (
select day, cast({abs_tons("sum(kg)", 0)} as hugeint) actual
from v_movement where cls = 'ROH' and place = 55 group by 1)"""

# Days on which anything was moved in one of the four slices.
MOVED_DAYS = """v_moved as (
select distinct day from v_movement where cls in ('ROH', 'HIBE') and place in (53, 55) or cls = 'KRSM' and place = 55)"""

RECIRCULATE = f"""v_recirculate as (
select day, cast(sum(t) as bigint) recirculates from (
  select day, material_id, {abs_tons("sum(kg)", 0)} t from v_movement
  where cls = 'KRSM' and place = 55 group by 1, 2) group by 1)"""

FLUX = f"""v_flux as (
select day, cast(sum(t) as bigint) fluxes from (
  select day, material_id, {abs_tons("sum(kg)", 0)} t from v_movement
  where cls = 'HIBE' and place in (53, 55) group by 1, 2) group by 1)"""


def part(name: str, where: str) -> str:
    """Day total of a material selection, in tenths."""
    return f"""v_{name} as (
select day, cast(sum(t) * 10 as hugeint) tenths from v_raw join v_material using (material_id)
where {where} group by 1)"""


# name -> material selection of the shares in the daily report
SHARES = {
    "main": "material_type = 'Cons' and category = 'H'",
    "side": "material_type = 'Cons' and category = 'N'",
    "intern": "material_type = 'Others' and category = 'RI'",
    "extern": "material_type = 'Others' and category = 'RE'",
    "other_secondary": "category in ('Ox', 'P')",
}


def share(tenths: str, actual: str) -> str:
    """Percentage in tenths, 0 without a denominator."""
    return (
        f"case when coalesce({actual}, 0) > 0 then "
        f"{half_even(f'coalesce({tenths}, 0) * 100', f'coalesce({actual}, 0)')} else 0 end"
    )


MEASURES = ",\n".join(
    [
        RAW_BY_MATERIAL,
        ACTUAL,
        RECIRCULATE,
        FLUX,
        *[part(name, where) for name, where in SHARES.items()],
        "v_measures as (select d.day, coalesce(actual, 0) actual, "
        + ", ".join(f"{share(f'v_{n}.tenths', 'actual')} {n}_tenths" for n in SHARES)
        + """, coalesce(recirculates, 0) recirculates, coalesce(fluxes, 0) fluxes
from v_base d left join v_actual on v_actual.day = d.day left join v_recirculate r on r.day = d.day
left join v_flux f on f.day = d.day """
        + " ".join(f"left join v_{n} on v_{n}.day = d.day" for n in SHARES)
        + ")",
    ]
)

# Daily plan of every version and month for slices given as v_slice(version, month, k, budget, forecast).
_MINUTES = "(day(last_day(month)) * 1440)"


def allocation(keys: str) -> str:
    """``keys``: the slice columns of v_slice, each followed by a comma, or empty."""
    joined = "".join(f"t.{k.strip()}, " for k in keys.split(",") if k.strip())

    def total(m: str) -> str:
        return half_even(f"cast({m} * 100 as hugeint) * 10 * ({_MINUTES} - 1)", _MINUTES)

    def rate(m: str, h: str) -> str:
        return half_even(
            f"{m}_total", f"greatest(cast(day(last_day(t.month)) * 24 as hugeint) - {h}_off, {MIN_WORKING_HOURS})"
        )

    return f"""v_total as (
select version, month, {keys} {total("budget")} budget_total, {total("forecast")} forecast_total from v_slice),
v_off as (
select version, cast(date_trunc('month', day) as date) as month, sum(b_hours) b_off, sum(f_hours) f_off
from v_shutdown where b_hours > 0 or f_hours > 0 group by 1, 2),
v_rate as (
select t.version, t.month, {joined} {rate("budget", "b")} b_rate, {rate("forecast", "f")} f_rate
from v_total t join v_off o on t.version = o.version and t.month = o.month
where budget_total <> 0 or forecast_total <> 0),
v_open as (
select version, month, {keys} b_rate, f_rate,
       cast(unnest(generate_series(cast(month as timestamp), cast(last_day(month) as timestamp), interval 1 day)) as date)
       as day
from v_rate),
v_daily as (
select t.version, t.day, {joined} (24 - coalesce(b_hours, 0)) * b_rate b_milli, (24 - coalesce(f_hours, 0)) * f_rate f_milli
from v_open t left join v_shutdown s on s.version = t.version and s.day = t.day)"""


def milli(c: str) -> str:
    return f"cast({c} as double) / 1000"


SLICE_ALL = """v_slice as (
select version, month, sum(budget) budget, sum(forecast) forecast
from v_plan where material_id in (select material_id from v_material) group by 1, 2)"""


def slice_by(keys: str) -> str:
    return f"""v_slice as (
select version, month, {keys}, sum(budget) budget, sum(forecast) forecast
from v_plan join v_material using (material_id) group by all)"""


PLANT = """v_plant as (
select cast(ts - interval 6 hour as date) as day, coalesce(sum(run_flag), 0) run_flag, coalesce(sum(feed), 0) feed,
       coalesce(sum(dust_set), 0) dust_set, coalesce(sum(dust_out), 0) dust_out, coalesce(sum(coal), 0) coal,
       coalesce(sum(slag), 0) slag
from v_telemetry group by 1)"""


def average(c: str, factor: int = 1) -> str:
    """A 24-hour average in hundredths, from a sum with two digits."""
    return half_even(f"cast({c} * {100 * factor} as hugeint)", "cast(24 as hugeint)")


def _label_where(kind: str | None, category: str | None) -> str:
    parts = []
    if kind:
        parts.append(f"material_type = '{kind}'")
    if category:
        parts.append(f"category = '{category}'")
    return " and ".join(parts) or "true"


def label_members(side: str) -> str:
    """v_<side>_label(label, material_id), one branch per line of the report."""
    branches = [
        f"select '{x.name}' label, material_id from v_material where "
        + _label_where(getattr(x, f"{side}_type"), getattr(x, f"{side}_category"))
        for x in LABELS
    ]
    return f"v_{side}_label as (" + "\nunion all ".join(branches) + ")"


LABEL_NAMES = "v_label as (select unnest([" + ", ".join(f"'{x.name}'" for x in LABELS) + "]) label)"
