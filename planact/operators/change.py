"""What is new or different in a plan against what is stored, and whether to load it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import compare
from planact.operators import calendar as cal
from planact.operators.plan import BUDGET, FORECAST

CELL = ["material_id", "month", "measure"]


def latest_values(plan_fact: DataFrame) -> DataFrame:
    """Latest non-null value per material, month and measure.

    ``max`` over (load time, value) keeps one candidate per key and map task, and gives the
    same row again if a task is repeated.
    """
    return (
        plan_fact.where(F.col("value").isNotNull() & F.col("material_id").isNotNull())
        .groupBy(*CELL)
        .agg(F.max(F.struct("inserted_at", "value")).alias("latest"))
        .select(*CELL, F.col("latest.value").alias("value"))
    )


def latest_versions(plan_fact: DataFrame) -> DataFrame:
    """Version of the latest non-null row per material and measure."""
    return (
        plan_fact.where(F.col("value").isNotNull() & F.col("material_id").isNotNull())
        .groupBy("material_id", "measure")
        .agg(F.max(F.struct("inserted_at", "version")).alias("latest"))
        .select("material_id", "measure", F.col("latest.version").alias("version"))
    )


def latest_shutdown(shutdown_fact: DataFrame) -> DataFrame:
    return (
        shutdown_fact.where(F.col("hours").isNotNull())
        .groupBy("day", "measure")
        .agg(F.max(F.struct("inserted_at", "hours")).alias("latest"))
        .select("day", "measure", F.col("latest.hours").alias("hours"))
    )


def versions(plan_fact: DataFrame) -> DataFrame:
    return plan_fact.select("version").distinct()


def materials_in_plan(plan_fact: DataFrame) -> DataFrame:
    return plan_fact.where(F.col("material_id").isNotNull()).select("material_id").distinct()


def new_materials(new_plan: DataFrame, plan_fact: DataFrame) -> DataFrame:
    """Ids of the new plan without any stored row; ids compare without outer blanks."""
    wanted = new_plan.select(F.trim("material_id").alias("material_id")).distinct()
    stored = materials_in_plan(plan_fact).select(F.trim("material_id").alias("material_id")).distinct()
    return wanted.join(stored, "material_id", "left_anti")


def _asked_for(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows of the keys the new rows ask about.

    The new rows are one workbook, the store is all history: joined in before the aggregate,
    they keep everything else out of its shuffle.
    """
    return stored.join(new.select(*keys).distinct(), keys, "left_semi")


def changed_versions(new_plan: DataFrame, plan_fact: DataFrame) -> DataFrame:
    """Materials whose latest stored version is not the new one (or that have none)."""
    wanted = new_plan.select("material_id", "measure", "version").distinct()
    keys = ["material_id", "measure"]
    stored = latest_versions(_asked_for(plan_fact, new_plan, keys)).withColumnRenamed("version", "stored_version")
    return wanted.join(stored, keys, "left").where(
        ~F.col("version").eqNullSafe(F.col("stored_version"))
    )


def changed_cells(new_plan: DataFrame, plan_fact: DataFrame, dim_time: DataFrame | None = None) -> DataFrame:
    """New cells that differ from the latest stored value, months unknown to the calendar skipped."""
    if dim_time is not None:
        new_plan = new_plan.join(cal.key_of_month(dim_time), "month", "left_semi")
    stored = latest_values(_asked_for(plan_fact, new_plan, CELL)).withColumnRenamed("value", "stored_value")
    joined = new_plan.select(*CELL, F.col("value").alias("new_value")).join(stored, CELL, "left")
    return joined.where(compare.value_changed(F.col("stored_value"), F.col("new_value"))).select(
        *CELL, "stored_value", "new_value"
    )


def changed_shutdown(
    new_shutdown: DataFrame, shutdown_fact: DataFrame, dim_time: DataFrame | None = None
) -> DataFrame:
    """New shutdown days without a stored value of their measure, or with a different one."""
    if dim_time is not None:
        new_shutdown = new_shutdown.join(cal.key_of_day(dim_time), "day", "left_semi")
    keys = ["day", "measure"]
    stored = latest_shutdown(_asked_for(shutdown_fact, new_shutdown, keys)).withColumnRenamed("hours", "stored_hours")
    joined = new_shutdown.select(*keys, F.col("hours").alias("new_hours")).join(stored, keys, "left")
    differs = F.col("stored_hours").isNull() | ~compare.is_close(F.col("stored_hours"), F.col("new_hours"))
    return joined.where(differs).select("day", "measure", "stored_hours", "new_hours")


def version_in_use(new_plan: DataFrame, plan_fact: DataFrame) -> DataFrame:
    """Versions of the new plan that are already stored."""
    return versions(new_plan).join(versions(plan_fact), "version", "left_semi")


@dataclass(frozen=True)
class Decision:
    """Why a load goes ahead or not. ``flags`` is one row; the rest are the findings."""

    flags: DataFrame
    new_materials: DataFrame
    changed_versions: DataFrame
    changed_cells: DataFrame
    changed_shutdown: DataFrame
    #: After a load: plan rows of the workbook, and how many were left out for what reason.
    counts: dict[str, int] = field(default_factory=dict)

    def should_load(self) -> bool:
        return bool(self.flags.first()["should_load"])


def _count(df: DataFrame, name: str) -> Column:
    return df.agg(F.count("*")).scalar().alias(name)


def _any(df: DataFrame, name: str) -> Column:
    """Whether ``df`` has a row, as a scalar subquery over a one-row prefix (an existence test)."""
    return (df.limit(1).agg(F.count("*") > 0)).scalar().alias(name)


def load_decision(
    new_plan: DataFrame,
    new_shutdown: DataFrame,
    plan_fact: DataFrame,
    shutdown_fact: DataFrame,
    dim_time: DataFrame | None = None,
) -> Decision:
    """All reasons as columns of one row, and ``should_load`` in their order of precedence.

    A version already stored refuses the load. Otherwise an empty store, a new material, a
    version or value change, or a shutdown change lets it through.
    """
    fresh = new_materials(new_plan, plan_fact)
    moved = changed_versions(new_plan, plan_fact)
    cells = changed_cells(new_plan, plan_fact, dim_time)
    down = changed_shutdown(new_shutdown, shutdown_fact, dim_time)
    empty = (plan_fact.limit(1).agg(F.count("*") == 0)).scalar() & (
        shutdown_fact.limit(1).agg(F.count("*") == 0)
    ).scalar()
    # One pass over the changed cells counts both measures; the two columns share the subquery.
    by_measure = cells.agg(
        F.struct(
            F.count_if(F.col("measure") == BUDGET).alias("b"), F.count_if(F.col("measure") == FORECAST).alias("f")
        )
    ).scalar()
    counted = new_plan.agg(F.count("*").alias("new_cells")).select(
        "new_cells",
        _any(version_in_use(new_plan, plan_fact), "version_in_use"),
        empty.alias("store_empty"),
        _count(fresh, "new_materials"),
        _count(moved, "changed_versions"),
        by_measure["b"].alias("changed_budget_cells"),
        by_measure["f"].alias("changed_forecast_cells"),
        _count(down, "changed_shutdown_days"),
    )
    reasons = (
        F.col("store_empty")
        | (F.col("new_materials") > 0)
        | (F.col("changed_versions") > 0)
        | (F.col("changed_budget_cells") > 0)
        | (F.col("changed_forecast_cells") > 0)
        | (F.col("changed_shutdown_days") > 0)
    )
    flags = counted.withColumn("should_load", ~F.col("version_in_use") & reasons)
    return Decision(flags, fresh, moved, cells, down)
