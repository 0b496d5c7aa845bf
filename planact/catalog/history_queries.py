"""The whole history of dense reports as runs, and the plan as it was known at several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.catalog import sql as q
from planact.catalog.core import query
from planact.functions import rounding as r
from planact.operators import actuals, asof, runs
from planact.operators import calendar as cal
from planact.sources import star_views as sv

_KNOWN = ("2023-12-31 00:00:00", "2024-01-01 00:00:00", "2024-02-15 12:00:00", "2024-06-01 00:00:00")


def _bounds(movements: DataFrame) -> tuple[Column, Column]:
    """First and last day of the data, each a scalar of a one-row aggregate."""
    both = movements.agg(F.struct(F.min("day").alias("lo"), F.max("day").alias("hi")).alias("b")).scalar()
    return both["lo"], both["hi"]


def _runs_sql(where: str, tons: str) -> str:
    """Gaps and islands over the dense grid."""
    return (
        q.with_(
            q.MATERIAL, q.MOVEMENT, q.HISTORY, q.RAW_BY_MATERIAL, tons,
            "v_dense as (select m.material_id, material_name, d.day, coalesce(t, 0) t from v_material m cross join v_days d "
            f"left join v_t on v_t.day = d.day and v_t.material_id = m.material_id where {where})",
            "v_isl as (select *, date_diff('day', date '1900-01-01', day) - row_number() over (partition by material_id, t order by day) g "
            "from v_dense)",
        )
        + "select material_id, material_name, strftime(min(day), '%Y-%m-%d') from_day, strftime(max(day), '%Y-%m-%d') to_day, "
        "cast(t as double) tons from v_isl group by material_id, material_name, t, g"
    )


_SIGNED = (
    f"v_t as (select day, material_id, {q.tons('sum(kg)', 1)} t from v_movement where cls = 'ROH' and place = 55 group by 1, 2)"
)
_ABSOLUTE = "v_t as (select * from v_raw)"


def _coded(spark: SparkSession, sf: str, choose: Callable[[DataFrame], DataFrame], rounding, column: str) -> DataFrame:
    moved = sv.movements(spark, sf)
    mass = actuals.day_material_mass(moved).where(F.col(column).isNotNull())
    series = mass.select("material_id", "day", rounding(column).alias("tenths"))
    chosen = choose(sv.materials(spark, sf)).select("material_id", "material_name")
    return runs.coded(series, chosen, *_bounds(moved), "tenths")


def _tons(df: DataFrame) -> DataFrame:
    return df.withColumn("tons", r.tenths_to_decimal("tenths")).drop("tenths")


def _everyone(materials: DataFrame) -> DataFrame:
    return materials


@query("signed_tons_runs", _runs_sql("true", _SIGNED))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Signed tons of every material over all days of the data."""
    return _tons(_coded(spark, sf, _everyone, r.signed_tenth_tons, "raw_main_mg"))


@query("concentrates_runs", _runs_sql("material_type = 'Cons'", _ABSOLUTE))
def _(spark: SparkSession, sf: str) -> DataFrame:
    def concentrates(materials: DataFrame) -> DataFrame:
        return actuals.select_materials(materials, actuals.SELECTIONS["concentrates"])

    return _tons(_coded(spark, sf, concentrates, r.abs_tenth_tons, "raw_mg"))


@query("named_material_runs", _runs_sql("material_name = (select min(material_name) from v_material)", _ABSOLUTE))
def _(spark: SparkSession, sf: str) -> DataFrame:
    def named(materials: DataFrame) -> DataFrame:
        return materials.where(F.col("material_name") == materials.agg(F.min("material_name")).scalar())

    return _tons(_coded(spark, sf, named, r.abs_tenth_tons, "raw_mg"))


@query(
    "signed_tons_from_runs",
    q.with_(q.MATERIAL, q.MOVEMENT, q.calendar("1998-01-01", "1998-01-31"), q.RAW_BY_MATERIAL, _SIGNED)
    + """select strftime(d.day, '%Y-%m-%d') as day, m.material_id, material_name, cast(coalesce(t, 0) as double) tons
from v_material m cross join v_days d left join v_t on v_t.day = d.day and v_t.material_id = m.material_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One month opened up from the runs of the whole history: the rows of the dense report."""
    coded = _coded(spark, sf, _everyone, r.signed_tenth_tons, "raw_main_mg")
    return _tons(runs.decoded(coded, cal.date_lit("1998-01-01"), cal.date_lit("1998-01-31")))


@query(
    "month_starts",
    q.with_(q.MOVEMENT, q.HISTORY)
    + "select strftime(day, '%Y-%m-%d') as month from v_days where day(day) = 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The months that begin within the data's own interval."""
    lo, hi = sv.movements(spark, sf).agg(F.min("day"), F.max("day")).first()
    return cal.months(spark, lo, hi)


def _known_sql() -> str:
    return q.with_(
        q.PLAN, q.PLAN_LONG,
        "v_known as (" + " union all ".join(
            f"select timestamp '{t}' known_at, material_id, month, measure, arg_max(value, inserted_at) as value, "
            f"arg_max(version, inserted_at) as version from v_plan_long where inserted_at <= timestamp '{t}' "
            "and value is not null group by material_id, month, measure"
            for t in _KNOWN
        ) + ")",
    )


@query(
    "plan_as_known",
    _known_sql() + "select strftime(known_at, '%Y-%m-%d %H:%M:%S') known_at, material_id, strftime(month, '%Y-%m-%d') as month, "
    "measure, cast(value as double) as value, version from v_known",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell as it was known before, at and between the loads, and after all of them."""
    return asof.plan_as_known(sv.plan(spark, sf), _KNOWN)


@query(
    "plan_totals_as_known",
    _known_sql() + "select strftime(known_at, '%Y-%m-%d %H:%M:%S') known_at, strftime(month, '%Y-%m-%d') as month, measure, "
    "cast(sum(value) as double) total from v_known group by v_known.known_at, v_known.month, measure",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return asof.totals_as_known(sv.plan(spark, sf), _KNOWN)
