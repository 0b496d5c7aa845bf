"""Plan and actual per material and day.

All joins are on the material alone: monthly totals are one row per material, the moved days
of a material are folded into a map of at most one entry per day, and the shutdown days of the
month are a single value. The days are opened up last, by a generator, so the dense
output is produced without shuffling it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.functions import rounding as r
from planact.operators import actuals, plan
from planact.operators import calendar as cal
from planact.plans.inputs import Inputs


def material_report(
    inputs: Inputs, start: cal.DateLike, end: cal.DateLike, version: str, mass: DataFrame | None = None
) -> DataFrame:
    """Every material on every day of the interval; a plan or actual that is missing reads 0.

    Plan and actuals cover the month of ``start``. Materials without a defined plan keep
    their actuals.
    """
    lo, hi = cal.as_date(start), cal.as_date(end)
    month, last = cal.month_of(lo), cal.end_of_month(lo)
    month_plan = plan.in_version(inputs.plan, version).where(F.col("month") == F.lit(month))
    month_down = plan.in_version(inputs.shutdown, version).where(F.col("day").between(F.lit(month), F.lit(last)))
    # Version and month are fixed, so the plan is grouped, shuffled and joined on the material only.
    monthly = plan.monthly_plan(month_plan, ["material_id"]).withColumn("month", F.lit(month))
    totals = plan.full_month_totals(monthly).select(
        "material_id", *[f"{m}_total" for m in (plan.BUDGET, plan.FORECAST)]
    )
    if mass is None:
        mass = actuals.day_material_mass(inputs.movements, lo, min(hi, last))
    moved = actuals.moved_days(mass, r.abs_tenth_tons("raw_mg"), "raw_mg")
    rows = inputs.materials.join(totals, "material_id", "left").join(moved, "material_id", "left")
    # One version and month: at most one row, a scalar. Without it the rates are null, the plan reads 0.
    down = plan.month_periods(month_down).select(
        F.struct(*[f"{m}_shutdown" for m in (plan.BUDGET, plan.FORECAST)], "hours_on").alias("down")
    )
    with_down = rows.withColumn("down", down.scalar()).select("*", "down.*").drop("down")
    rated = plan.rates(with_down, F.lit(month), F.lit(last))
    opened = cal.each_day(rated, cal.date_lit(lo), cal.date_lit(hi))
    in_month = F.col("day").between(F.lit(month), F.lit(last))
    planned = {
        m: F.coalesce(F.when(in_month, plan.day_value(m)), F.lit(0).cast("decimal(24,3)"))
        for m in (plan.BUDGET, plan.FORECAST)
    }
    return opened.select(
        "day",
        "material_name",
        "material_id",
        "material_type",
        "category",
        *[c.alias(m) for m, c in planned.items()],
        r.tenths_to_decimal(actuals.TENTHS_ON_DAY).alias("actual"),
    )
