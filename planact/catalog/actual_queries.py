"""Actuals over the whole movement table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.catalog import sql as q
from planact.catalog.core import query
from planact.functions import rounding as r
from planact.operators import actuals
from planact.sources import star_views as sv

# Dense outputs (every material on every day) take the interval of one report.
MONTH_START, MONTH_END = "1998-01-01", "1998-01-31"

_HISTORY = q.HISTORY
_MONTH = q.calendar(MONTH_START, MONTH_END)
_BASE = "v_base as (select day from v_days)"


def history(spark: SparkSession, sf: str) -> tuple[dt.date, dt.date]:
    """First and last day of the movements."""
    return tuple(sv.movements(spark, sf).agg(F.min("day"), F.max("day")).first())


@query(
    "actual_daily_total",
    q.with_(q.MOVEMENT, q.ACTUAL, _HISTORY)
    + f"select {q.DAY}, cast(coalesce(actual, 0) as bigint) tons from v_days left join v_actual using (day)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return actuals.daily_total(sv.movements(spark, sf), *history(spark, sf))


_SUMMARY = (
    "v_sum as (select day, material_id, label, sum(round_even(kg * 0.001, 1)) t "
    "from v_movement where cls = 'ROH' and place = 55 and material_id is not null and label is not null "
    "and kg is not null group by 1, 2, 3)"
)


@query(
    "movement_summary",
    q.with_(q.MOVEMENT, _SUMMARY) + f"select {q.DAY}, material_id, label, cast(t as double) tons from v_sum",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return actuals.movement_summary(sv.movements(spark, sf))


@query(
    "movement_summary_total",
    q.with_(q.MOVEMENT, _SUMMARY) + f"select {q.DAY}, cast(sum(t) as double) tons from v_sum group by day",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return actuals.movement_summary_total(sv.movements(spark, sf))


@query(
    "signed_tons_by_material",
    q.with_(q.MATERIAL, q.MOVEMENT, _MONTH)
    + f"""select strftime(d.day, '%Y-%m-%d') as day, m.material_id, material_name, cast(coalesce(t, 0) as double) tons
from v_material m cross join v_days d left join (
  select day, material_id, {q.tons("sum(kg)", 1)} t from v_movement where cls = 'ROH' and place = 55 group by 1, 2) x
on x.day = d.day and x.material_id = m.material_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return actuals.signed_by_material(sv.movements(spark, sf), sv.materials(spark, sf), MONTH_START, MONTH_END)


# selection -> the same selection in SQL
_WHERE = {
    "all_materials": "true",
    "concentrates": "material_type = 'Cons'",
    "concentrates_h": "material_type = 'Cons' and category = 'H'",
    "concentrates_n": "material_type = 'Cons' and category = 'N'",
    "concentrates_pk": "material_type = 'Cons' and category = 'PK'",
    "pastes": "material_type = 'Paste'",
    "pastes_p": "material_type = 'Paste' and category = 'P'",
    "others": "material_type = 'Others'",
    "others_ri": "material_type = 'Others' and category = 'RI'",
    "others_re": "material_type = 'Others' and category = 'RE'",
    "others_ox": "material_type = 'Others' and upper(category) = 'OX'",
    "other_secondary": "upper(category) in ('OX', 'P')",
}


def _register_shares(name: str, where: str) -> None:
    text = (
        q.with_(q.MATERIAL, q.MOVEMENT, _HISTORY, q.RAW_BY_MATERIAL, q.ACTUAL, q.part("part", where))
        + f"select strftime(d.day, '%Y-%m-%d') as day, cast(coalesce(tenths, 0) as double) / 10 tons, "
        f"cast({q.share('tenths', 'actual')} as double) / 10 pct "
        "from v_days d left join v_part p on p.day = d.day left join v_actual a on a.day = d.day"
    )

    @query(f"daily_{name}", text)
    def _(spark: SparkSession, sf: str) -> DataFrame:
        return actuals.daily_share(
            sv.movements(spark, sf), sv.materials(spark, sf), actuals.SELECTIONS[name], *history(spark, sf)
        )


for _name, _where in _WHERE.items():
    _register_shares(_name, _where)


@query(
    "monthly_totals",
    q.with_(q.MATERIAL, q.MOVEMENT, q.RAW_BY_MATERIAL)
    + "select m.month, s.selection, cast(coalesce(t, 0) as double) tons "
    "from (select distinct strftime(day, '%Y-%m') as month from v_movement where place in (53, 55)) m cross join ("
    + " union all ".join(f"select '{name}' selection" for name in _WHERE)
    + ") s left join ("
    + "\nunion all ".join(
        f"select strftime(day, '%Y-%m') as month, '{name}' selection, sum(t) t "
        f"from v_raw join v_material using (material_id) where {where} group by 1"
        for name, where in _WHERE.items()
    )
    + ") x on x.month = m.month and x.selection = s.selection",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All selections from one scan: one sum per selection, then one row per selection."""
    mass = actuals.day_material_mass(sv.movements(spark, sf))
    measured = actuals.measures_by_day(mass, sv.materials(spark, sf), actuals.SELECTIONS)
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("selection"), r.tenths_to_decimal(f"{n}_tenths").alias("tons"))
            for n in actuals.SELECTIONS
        ]
    )
    long = measured.select(F.date_format("day", "yyyy-MM").alias("month"), F.inline(pairs))
    return long.groupBy("month", "selection").agg(F.sum("tons").alias("tons"))


@query(
    "monthly_concentrates",
    q.with_(q.MATERIAL, q.MOVEMENT, q.RAW_BY_MATERIAL, _HISTORY, q.part("part", _WHERE["concentrates"]))
    + "select strftime(d.day, '%Y-%m') as month, cast(sum(coalesce(tenths, 0)) as double) / 10 tons "
    "from v_days d left join v_part p on p.day = d.day group by 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    daily = actuals.daily_share(
        sv.movements(spark, sf), sv.materials(spark, sf), actuals.SELECTIONS["concentrates"], *history(spark, sf)
    )
    return actuals.monthly_totals(daily)


def _dense(where: str) -> str:
    return (
        q.with_(q.MATERIAL, q.MOVEMENT, _MONTH, q.RAW_BY_MATERIAL)
        + f"""select strftime(d.day, '%Y-%m-%d') as day, m.material_id, material_name, cast(coalesce(t, 0) as double) tons
from v_material m cross join v_days d left join v_raw r on r.day = d.day and r.material_id = m.material_id
where {where}"""
    )


@query("concentrates_by_material", _dense("material_type = 'Cons'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return actuals.daily_by_material(
        sv.movements(spark, sf), sv.materials(spark, sf), actuals.SELECTIONS["concentrates"], MONTH_START, MONTH_END
    )


@query("named_material_by_day", _dense("material_name = (select min(material_name) from v_material)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    materials = sv.materials(spark, sf)
    named = materials.where(F.col("material_name") == materials.agg(F.min("material_name")).scalar())
    everything = actuals.SELECTIONS["all_materials"]
    return actuals.daily_by_material(sv.movements(spark, sf), named, everything, MONTH_START, MONTH_END)


def _register_side_stream(name: str, which: str, where: str, view: str, column: str) -> None:
    by_material = (
        q.with_(q.MOVEMENT)
        + f"select {q.DAY}, material_id, cast({q.abs_tons('sum(kg)', 0)} as bigint) tons from v_movement "
        f"where {where} group by v_movement.day, material_id"
    )

    @query(f"{name}_by_material", by_material)
    def _(spark: SparkSession, sf: str) -> DataFrame:
        return actuals.side_stream(sv.movements(spark, sf), which)

    per_day = (
        q.with_(q.MOVEMENT, view, _HISTORY)
        + f"select {q.DAY}, coalesce({column}, 0) tons from v_days left join v_{which} using (day)"
    )

    @query(f"{name}_daily", per_day)
    def _(spark: SparkSession, sf: str) -> DataFrame:
        return actuals.side_stream_daily(sv.movements(spark, sf), which, *history(spark, sf))


_register_side_stream("recirculates", "recirculate", "cls = 'KRSM' and place = 55", q.RECIRCULATE, "recirculates")
_register_side_stream("fluxes", "flux", "cls = 'HIBE' and place in (53, 55)", q.FLUX, "fluxes")


@query(
    "daily_measures",
    q.with_(q.MATERIAL, q.MOVEMENT, _HISTORY, _BASE, q.MEASURES)
    + f"select {q.DAY}, cast(actual as bigint) actual, "
    + ", ".join(f"cast({n}_tenths as double) / 10 {n}_pct" for n in q.SHARES)
    + ", recirculates, fluxes from v_measures",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    mass = actuals.day_material_mass(sv.movements(spark, sf))
    return actuals.daily_measures(mass, sv.materials(spark, sf), *history(spark, sf))


@query(
    "movement_slices",
    q.with_(q.MOVEMENT)
    + """select cls, place, count(*) movements, cast(sum(kg) as double) kg, count(distinct day) as days
from v_movement where place in (53, 55) and cls in ('ROH', 'KRSM', 'HIBE') group by 1, 2""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    slices = actuals.slice_conditions()
    return (
        sv.movements(spark, sf)
        .where(slices["raw"] | (actuals.both_places() & actuals.in_class("KRSM")) | slices["flux"])
        .groupBy("cls", "place")
        .agg(
            F.count("*").alias("movements"),
            (F.sum(r.milligrams("kg")) / r.MG_PER_KG).alias("kg"),
            F.count_distinct("day").alias("days"),
        )
    )
