"""The older report table: seven text measures per day, upserted by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.functions import display
from planact.operators import actuals
from planact.operators import calendar as cal
from planact.plans.inputs import Inputs

KEY = "monthday"


def legacy_rows(inputs: Inputs, start: cal.DateLike, end: cal.DateLike) -> DataFrame:
    """One row of text per day of the interval."""
    mass = actuals.day_material_mass(inputs.movements, start, end)
    days = actuals.daily_measures(mass, inputs.materials, start, end)
    moved = F.col("actual") > 0
    return days.select(
        F.col("day").alias(KEY),
        display.tons(F.col("actual")).alias("actual"),
        *[display.percent(F.col(f"{name}_pct"), moved).alias(name) for name in actuals.DAILY_SHARES],
        display.tons(F.col("fluxes")).alias("fluxes"),
    )
