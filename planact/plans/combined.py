"""All three reports of one request, from one pass over the movements."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.operators import actuals, plan
from planact.operators import calendar as cal
from planact.plans import category_sums, daily_report, material_report
from planact.session import stage, staging
from planact.sinks import reports
from planact.plans.inputs import Inputs


@dataclass(frozen=True)
class CombinedReport:
    params: DataFrame
    daily: DataFrame
    sums: DataFrame
    by_material: DataFrame


def combined_report(inputs: Inputs, start: cal.DateLike, end: cal.DateLike, version: str) -> CombinedReport:
    """The three reports and the parameters they were made with.

    The day-by-material aggregate of the movements and the month's plan per material are each
    written once to the shared folder and feed all three, so the large tables are scanned once
    for the whole request.
    """
    lo, hi = cal.as_date(start), cal.as_date(end)
    month_plan = plan.in_version(inputs.plan, version).where(F.col("month") == F.lit(cal.month_of(lo)))
    keys = ["version", "material_id", "month", "measure"]
    summed = month_plan.groupBy(*keys).agg(F.sum("value").alias("value"))
    inputs = replace(inputs, plan=stage(summed, "month-plan"))
    mass = stage(actuals.day_material_mass(inputs.movements, lo, hi), "day-material")
    # Daily and per-material figures stop at the end of the first month, the sums do not.
    month_mass = cal.in_interval(mass, lo, min(hi, cal.end_of_month(lo)))
    return CombinedReport(
        params=parameters(mass.sparkSession, lo, hi, version),
        daily=daily_report.daily_report(inputs, lo, hi, version, mass=month_mass),
        sums=category_sums.category_sums(inputs, lo, hi, version, mass=mass),
        by_material=material_report.material_report(inputs, lo, hi, version, mass=month_mass),
    )


def parameters(spark: SparkSession, start: cal.DateLike, end: cal.DateLike, version: str) -> DataFrame:
    """The parameter block that heads every part."""
    rows = {
        "Start Date:": f"{cal.as_date(start)} 00:00",
        "End Date:": f"{cal.as_date(end)} 23:59",
        "Version Name:": version,
    }
    pairs = [F.struct(F.lit(k).alias("description"), F.lit(v).alias("value")) for k, v in rows.items()]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def write_combined_report(
    inputs: Inputs, start: cal.DateLike, end: cal.DateLike, version: str, folder: str
) -> dict[str, str]:
    """Write the parts below ``folder/Report_<start>_<end>``; empty parts are skipped, an unknown version raises."""
    if plan.in_version(inputs.plan, version).isEmpty():
        raise ValueError(f"the plan has no version {version}")
    with staging(inputs.plan.sparkSession):
        report = combined_report(inputs, start, end, version)
        return reports.write_report(
            folder,
            start,
            end,
            report.params,
            {"report": report.daily, "category_sums": report.sums, "report_per_material": report.by_material},
        )
