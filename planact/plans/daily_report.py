"""The daily report: plan, actual, shares, side streams and plant figures per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import display
from planact.functions import rounding as r
from planact.operators import actuals, plan, telemetry
from planact.operators import calendar as cal
from planact.plans.inputs import Inputs

SHARES = tuple(f"{name}_pct" for name in actuals.DAILY_SHARES)

COLUMNS = (
    "day", "forecast", "budget", "actual", *SHARES,
    "recirculates", "fluxes", "availability_pct", "avg_feed", "pb_in_slag",
)

_SHOWN = {
    "forecast": 0, "budget": 0, "actual": 0, **dict.fromkeys(SHARES, 1),
    "recirculates": 0, "fluxes": 0, "availability_pct": 1, "avg_feed": 0, "pb_in_slag": 1,
}

# --- fixed values: column titles of the rendered report ------------------------------------------
TITLES = {
    "day": "Day",
    "forecast": "Forecast in t",
    "budget": "Budget in t",
    "actual": "Actual in t",
    "main_pct": "Concentrates Main",
    "side_pct": "Concentrates Side",
    "intern_pct": "Leach Products Intern",
    "extern_pct": "Leach Products Extern",
    "other_secondary_pct": "Other Secondary",
    "recirculates": "Non Raw Materials Recirculates in t/d",
    "fluxes": "Non Raw Materials Fluxes in t/d",
    "availability_pct": "Availability",
    "avg_feed": "Average Feed in t/h",
    "pb_in_slag": "Average Pb in Slag",
}
# --------------------------------------------------------------------------------------------------


def _assemble(plan_days: DataFrame, plant: DataFrame, measures: DataFrame, keys: list[str]) -> DataFrame:
    """Join the three sides. Days of the plan without telemetry show zeros throughout."""
    figures = telemetry.day_figures(plant).withColumn("has_telemetry", F.lit(True))
    observed = figures.join(measures, "day", "left")
    joined = plan_days.join(observed, "day", "left")
    seen = F.col("has_telemetry").isNotNull()

    def shown(name: str, value: Column) -> Column:
        return r.half_even(F.when(seen, F.coalesce(value, F.lit(0))).otherwise(F.lit(0)).cast("decimal(24,2)"),
                           _SHOWN[name]).cast(f"decimal(24,{_SHOWN[name]})").alias(name)

    returned = F.col("returned_dust") + F.coalesce(F.col("recirculates"), F.lit(0)).cast("decimal(20,0)")
    return joined.select(
        *keys,
        *[r.half_even(F.col(m), 0).cast("decimal(24,0)").alias(m) for m in (plan.FORECAST, plan.BUDGET)],
        shown("actual", F.col("actual")),
        *[shown(c, F.col(c)) for c in SHARES],
        shown("recirculates", returned),
        shown("fluxes", F.col("fluxes")),
        *[shown(c, F.col(c)) for c in ("availability_pct", "avg_feed", "pb_in_slag")],
        seen.alias("has_telemetry"),
    )


def daily_numbers(
    inputs: Inputs,
    start: cal.DateLike,
    end: cal.DateLike,
    version: str,
    complete_days: bool = False,
    mass: DataFrame | None = None,
) -> DataFrame:
    """The report as numbers, with ``has_telemetry`` telling observed days from planned ones.

    Plan and actuals cover the month of ``start``; a longer interval shows only telemetry
    beyond it. Without a defined plan in that month there is no report. Days appear if they
    have telemetry or a plan; ``complete_days`` shows every day of the interval with its
    actuals.
    """
    lo, hi = cal.as_date(start), cal.as_date(end)
    month, last = cal.month_of(lo), cal.end_of_month(lo)
    rates = plan.month_rates(inputs.plan, inputs.shutdown, inputs.materials, version, lo)
    # One row or none: a scalar. Without it no day is left.
    defined = rates.select(F.struct("budget_rate", "forecast_rate", "hours_on").alias("plan")).scalar()
    days = cal.days(inputs.plan.sparkSession, lo, hi).withColumn("plan", defined)
    days = days.where(F.col("plan").isNotNull()).select("day", "plan.*")
    in_month = F.col("day").between(F.lit(month), F.lit(last))
    plan_days = days.select(
        "day", *[F.when(in_month, plan.day_value(m)).alias(m) for m in (plan.BUDGET, plan.FORECAST)]
    )
    if mass is None:
        mass = actuals.day_material_mass(inputs.movements, lo, min(hi, last))
    measures = actuals.daily_measures(mass, inputs.materials)
    plant = telemetry.by_production_day(telemetry.in_report_range(inputs.telemetry, lo))
    plant = cal.in_interval(plant, lo, hi)
    if complete_days:
        sums = [c for c in plant.columns if c != "day"]
        plant = cal.days(mass.sparkSession, lo, hi).join(plant, "day", "left").fillna(0, sums)
    report = _assemble(plan_days, plant, measures, ["day"])
    # Every day of a defined month is planned; other days appear if they have telemetry.
    return report.where(F.col("budget").isNotNull() | F.col("has_telemetry"))


def daily_report(
    inputs: Inputs, start: cal.DateLike, end: cal.DateLike, version: str, **options
) -> DataFrame:
    """The fourteen columns of the report as numbers, by day."""
    return daily_numbers(inputs, start, end, version, **options).select(*COLUMNS).orderBy("day")


def daily_history(inputs: Inputs, version: str | None = None) -> DataFrame:
    """The report of every month and version in one pass, each month as its own request.

    Movements and telemetry are reduced to one row per day before they meet the plan days.
    """
    plan_days = plan.allocate_months(inputs.plan, inputs.shutdown, inputs.materials, version=version)
    mass = actuals.day_material_mass(inputs.movements)
    measures = actuals.daily_measures(mass, inputs.materials)
    plant = telemetry.by_production_day(inputs.telemetry)
    return _assemble(plan_days, plant, measures, ["version", "day"]).drop("has_telemetry")


def render(numbers: DataFrame) -> DataFrame:
    """The report as text. Shares read ``0 %`` on days without any raw material."""
    seen = F.col("has_telemetry")
    moved = seen & (F.col("actual") > 0)
    texts = {
        "day": display.iso_day(F.col("day")),
        **{c: display.whole(F.col(c)) for c in ("forecast", "budget", "actual", "recirculates", "fluxes", "avg_feed")},
        **{c: display.percent(F.col(c), moved) for c in SHARES},
        "availability_pct": display.percent(F.col("availability_pct"), seen),
        "pb_in_slag": display.percent(F.col("pb_in_slag"), seen),
    }
    return numbers.orderBy("day").select(*[texts[c].alias(TITLES[c]) for c in COLUMNS])
