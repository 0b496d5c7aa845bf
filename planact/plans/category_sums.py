"""Sums of plan and actual under overlapping labels.

Membership depends on type and category only. Plan and actuals are therefore summed to
(type, category) first, a few dozen rows, and only those are repeated under their labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import materials as mat
from planact.functions import rounding as r
from planact.operators import actuals, plan
from planact.operators import calendar as cal
from planact.plans.inputs import Inputs


@dataclass(frozen=True)
class Label:
    """A line of the report. Plan and actual may select different materials."""

    name: str
    plan_type: str | None
    plan_category: str | None
    actual_type: str | None
    actual_category: str | None


# --- fixed values: the lines of the report ------------------------------------------------------
LABELS = (
    Label("Paid Raw Materials", None, None, None, None),
    Label("Delta Concentrates", "Cons", None, "Cons", None),
    Label("Delta Paste", None, "P", "Paste", None),
    Label("Delta Others", "Others", None, "Others", None),
    Label("Category H", None, "H", "Cons", "H"),
    Label("Category N", None, "N", "Cons", "N"),
    Label("Category PK", None, "PK", "Cons", "PK"),
    Label("Category P", None, "P", "Paste", "P"),
    Label("Category Ox", None, "Ox", "Others", "Ox"),
    Label("Category RI", None, "RI", "Others", "RI"),
    Label("Category RE", None, "RE", "Others", "RE"),
)
# ------------------------------------------------------------------------------------------------


def _member(material_type: str | None, category: str | None) -> Column:
    cond = F.lit(True)
    if material_type:
        cond = cond & mat.same_text(F.col("material_type"), material_type)
    if category:
        cond = cond & mat.same_text(F.col("category"), category)
    return F.coalesce(cond, F.lit(False))


def _labels(side: str) -> Column:
    """Array of the labels a (type, category) belongs to on one side of the report."""
    names = [
        F.when(_member(getattr(x, f"{side}_type"), getattr(x, f"{side}_category")), F.lit(x.name)) for x in LABELS
    ]
    return F.array_compact(F.array(*names))


def _line_names(keys_of: DataFrame) -> DataFrame:
    """Every line of the report for every key row, from a literal array of eleven names."""
    return keys_of.select("*", F.explode(F.array(*[F.lit(x.name) for x in LABELS])).alias("label"))


def plan_by_label(facts: DataFrame, materials: DataFrame) -> DataFrame:
    """Monthly plan per version, month and label."""
    grouped = plan.plan_slices(facts, materials, by=("material_type", "category"))
    return (
        grouped.withColumn("label", F.explode(_labels("plan")))
        .groupBy("version", "month", "label")
        .agg(*[F.sum(m).cast("decimal(20,2)").alias(m) for m in (plan.BUDGET, plan.FORECAST)])
    )


def actual_by_label(mass: DataFrame, materials: DataFrame, by_month: bool = False) -> DataFrame:
    """Tenths per label, summed over materials and days rounded one by one."""
    moved = actuals.material_days(mass, materials)
    keys = ["month"] if by_month else []
    if by_month:
        moved = moved.withColumn("month", F.trunc("day", "MM"))
    grouped = moved.groupBy(*keys, "material_type", "category").agg(F.sum("tenths").alias("tenths"))
    return (
        grouped.withColumn("label", F.explode(_labels("actual")))
        .groupBy(*keys, "label")
        .agg(F.sum("tenths").alias("tenths"))
    )


def _shape(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines without a defined plan read 0 throughout, the actual included."""
    defined = F.col("budget").isNotNull()
    zero = F.lit(0).cast("decimal(24,3)")
    return lines.select(
        *keys,
        "label",
        F.coalesce(F.col("budget"), zero).cast("decimal(24,3)").alias("total_budget"),
        F.coalesce(F.col("forecast"), zero).cast("decimal(24,3)").alias("total_forecast"),
        F.when(defined, r.tenths_to_decimal("coalesce(tenths, 0L)"))
        .otherwise(F.lit(0).cast("decimal(20,1)"))
        .alias("total_actual"),
    )


def category_sums(
    inputs: Inputs, start: cal.DateLike, end: cal.DateLike, version: str, mass: DataFrame | None = None
) -> DataFrame:
    """Eleven lines: plan allocated over the month of ``start``, both sides summed over the interval."""
    lo, hi = cal.as_date(start), cal.as_date(end)
    month_plan = plan.in_version(inputs.plan, version).where(F.col("month") == F.lit(cal.month_of(lo)))
    month_down = plan.in_version(inputs.shutdown, version).where(
        F.col("day").between(F.lit(cal.month_of(lo)), F.lit(cal.end_of_month(lo)))
    )
    slices = plan_by_label(month_plan, inputs.materials)
    planned = plan.allocate_slices(slices, month_down, ("label",), version)
    wanted = F.col("day").between(F.lit(lo), F.lit(hi))
    plan_sums = planned.groupBy("label").agg(
        *[F.coalesce(F.sum(F.when(wanted, F.col(m))), F.lit(0)).alias(m) for m in (plan.BUDGET, plan.FORECAST)]
    )
    if mass is None:
        mass = actuals.day_material_mass(inputs.movements, lo, hi)
    actual_sums = actual_by_label(mass, inputs.materials)
    names = _line_names(inputs.materials.sparkSession.range(1).select())
    return _shape(names.join(plan_sums, "label", "left").join(actual_sums, "label", "left"), [])


def category_sums_history(inputs: Inputs, version: str | None = None) -> DataFrame:
    """The same lines for every month and version, each full month as its own request."""
    slices = plan_by_label(plan.in_version(inputs.plan, version), inputs.materials)
    planned = plan.allocate_slices(slices, plan.in_version(inputs.shutdown, version), ("label",), version)
    plan_sums = planned.groupBy("version", F.trunc("day", "MM").alias("month"), "label").agg(
        *[F.sum(m).alias(m) for m in (plan.BUDGET, plan.FORECAST)]
    )
    mass = actuals.day_material_mass(inputs.movements)
    actual_sums = actual_by_label(mass, inputs.materials, by_month=True)
    # The labels of a month as one map of at most eleven entries, so that every line is shown
    # without planning the month a second time.
    sums = F.struct("label", F.struct(plan.BUDGET, plan.FORECAST).alias("sums"))
    by_month = plan_sums.groupBy("version", "month").agg(F.map_from_entries(F.collect_list(sums)).alias("on_label"))
    found = F.try_element_at("on_label", F.col("label"))
    lines = _line_names(by_month).select(
        "version", "month", "label", *[found[m].alias(m) for m in (plan.BUDGET, plan.FORECAST)]
    )
    lines = lines.join(actual_sums, ["month", "label"], "left")
    return _shape(lines, ["version", "month"])
