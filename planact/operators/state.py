"""The latest state of the stored plan, and digests of its versions.

History only grows; what a load has to know about it does not. The state holds one row per cell (material, month,
measure) with its latest value and version, merged on every load from the rows of that load and from the state of the months they
touch. Digests are two order-independent sums of hashes over the cells of a (version, month, measure), and of the
latest state under no version: equal digests are equal cells, whatever the order they were stored in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planact.functions import compare
from planact.operators import calendar as cal
from planact.operators.change import CELL, Decision
from planact.operators.plan import BUDGET, FORECAST
from planact.session import stage

DAY = ["day", "measure"]
MATERIAL = ["material_id", "measure"]


def _stored(stamp: str, value: str) -> list[Column]:
    """The latest value and the latest version, each by (time, itself), among rows that have a value."""
    has = F.col(value).isNotNull()
    return [
        F.max(F.when(has, F.struct(stamp, value))).alias("v"),
        F.max(F.when(has, F.struct(stamp, "version"))).alias("w"),
    ]


def _latest(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*_stored("inserted_at", value)).select(
        *keys, F.col("v")[value].alias(value), F.col("w.version").alias("version"), F.col("w.inserted_at").alias("inserted_at")
    )


def plan_state(rows: DataFrame, *more: str) -> DataFrame:
    """One row per cell with its latest value, version and time; cells never filled have none.

    ``rows`` are facts, states or both: the state of a state and of newer facts is that of all facts. ``more`` names
    columns that follow from the cell; rows that are spread by these are not shuffled again.
    """
    return _latest(rows.where(F.col("material_id").isNotNull()), [*more, *CELL], "value")


def shutdown_state(rows: DataFrame, *more: str) -> DataFrame:
    return _latest(rows, [*more, *DAY], "hours")


def digests(rows: DataFrame, *by: str) -> DataFrame:
    """(by, month, measure, cells, low, high): order-independent sums of two hashes of every cell.

    Nulls and zeros are equal, as in the comparison of cells. Sums are exact, so partial ones merge in any
    order; nothing but one row per group leaves a map task.
    """
    cell = F.struct(F.col("material_id"), F.coalesce("value", F.lit(0).cast("decimal(18,2)")).alias("value"))

    def summed(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), cell).cast("decimal(28,0)"))

    return rows.groupBy(*by, "month", "measure").agg(
        F.count("*").alias("cells"), summed(1).alias("low"), summed(2).alias("high")
    )


def differing(new: DataFrame, stored: DataFrame) -> DataFrame:
    """(month, measure) of the new digests that the stored ones do not hold in the same form."""
    keys = ["month", "measure", "cells", "low", "high"]
    return new.select(*keys).join(stored.select(*keys), keys, "left_anti").select("month", "measure")


def same_versions(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored versions that hold exactly the cells of the new plan; both sides are digests, not cells."""
    keys = ["month", "measure", "cells", "low", "high"]
    wanted = new.agg(F.count("*").alias("wanted"))
    met = stored.where(F.col("version").isNotNull()).join(
        F.broadcast(new.select(*keys, F.lit(1).alias("met"))), keys, "left"
    )
    held = met.groupBy("version").agg(F.count("*").alias("groups"), F.count("met").alias("met"))
    return held.where((F.col("groups") == wanted.scalar()) & (F.col("met") == F.col("groups"))).select("version")


@dataclass(frozen=True)
class Known:
    """What is known of the store without looking into it: its versions, and whether it holds anything."""

    versions: frozenset[str]
    empty: bool


def _news(new_plan: DataFrame, dim_time: DataFrame | None) -> DataFrame:
    """New rows beside the state's columns; ``asked``: their month is known to the calendar."""
    rows = new_plan.select(*CELL, "value", "version")
    if dim_time is None:
        return rows.withColumn("asked", F.lit(True))
    months = cal.key_of_month(dim_time).select("month", F.lit(True).alias("asked"))
    return rows.join(months, "month", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))


def _compared(news: DataFrame, state: DataFrame) -> DataFrame:
    """New rows with the ``change`` of their cell, if any, and the rows of the state, which has one per cell.

    Both are spread by material and measure, together: their cells and all that is asked of a material are then found
    without moving a row again, and rows of a material that stood together still do, which packs well.
    """
    news = news.withColumn("new_rows", F.lit(1))
    olds = state.select(
        *CELL, F.col("value").alias("own_value"), F.struct("inserted_at", "version").alias("stored"), F.lit(1).alias("old_rows")
    )
    both = news.unionByName(olds, allowMissingColumns=True).repartition(*MATERIAL)
    named = F.col("material_id").isNotNull() & F.col("month").isNotNull() & F.col("measure").isNotNull()
    stored = F.when(named, F.max("own_value").over(Window.partitionBy(*CELL)))
    return _with_change(both.withColumn("stored_value", stored))


def _with_change(rows: DataFrame) -> DataFrame:
    differs = F.col("asked") & compare.value_changed(F.col("stored_value"), F.col("new_value"))
    return rows.withColumn("change", F.when(differs, F.struct("month", "stored_value", "new_value")))


def _stored_pairs(new_plan: DataFrame, stored: DataFrame) -> DataFrame:
    """(month, measure, look) of the state; ``look``: the new plan has the pair, and not with equal cells."""
    keys, cells = ["month", "measure"], F.struct("cells", "low", "high")
    new = digests(new_plan).select(*keys, cells.alias("new"))
    look = F.col("new").isNotNull() & (F.col("new") != F.col("stored"))
    return stored.select(*keys, cells.alias("stored")).join(new, keys, "left").select(*keys, F.coalesce(look, F.lit(False)).alias("look"))


def _changed(news: DataFrame, state: DataFrame, pairs: DataFrame) -> DataFrame:
    """The changed cells of new rows; ``pairs``: see :func:`_stored_pairs`.

    Cells are only brought together for the months whose digests differ: equal digests are equal cells, and where the
    state has no cells there is nothing stored to differ from.
    """
    news = news.join(F.broadcast(pairs), ["month", "measure"], "left")  # months of a calendar
    olds = state.join(F.broadcast(pairs.where("look")), ["month", "measure"], "left_semi")
    found = _compared(news.where("look").drop("look"), olds)
    kind = state.schema["value"].dataType
    fresh = _with_change(news.where("look is null").withColumn("stored_value", F.lit(None).cast(kind)))
    return found.select(*MATERIAL, "change").unionByName(fresh.select(*MATERIAL, "change")).where("change is not null")


def decision(
    new_plan: DataFrame,
    new_shutdown: DataFrame,
    plan: DataFrame,
    shutdown: DataFrame,
    known: Known,
    dim_time: DataFrame | None = None,
    stored_digests: DataFrame | None = None,
) -> Decision:
    """As ``change.load_decision``, from the state instead of the history.

    ``plan`` and ``shutdown`` are states, ``stored_digests`` those of the plan's, if they are kept. A new id counts as new if no stored id equals it without outer blanks.
    What is found is written down, a row per material and measure, so that it stays what it was when the state moves on.
    """
    per_measure = stage(_per_measure(new_plan, plan, dim_time, stored_digests), "plan-decision")
    days = stage(_days(new_shutdown, shutdown, dim_time), "shutdown-decision")
    per_name = per_measure.groupBy("name").agg(
        F.sum("new_cells").alias("new_cells"),
        F.max("old").alias("old"),
        F.sum(F.size("moved")).alias("moved"),
        *[F.sum(F.when(F.col("measure") == m, F.size("changed"))).alias(m) for m in (BUDGET, FORECAST)],
        F.max(F.exists("versions", lambda v: v.isin(*known.versions)) if known.versions else F.lit(False)).alias("used"),
    )
    zero = F.lit(0).cast("long")
    flags = per_name.agg(
        F.coalesce(F.sum("new_cells"), zero).alias("new_cells"),
        F.coalesce(F.max("used"), F.lit(False)).alias("version_in_use"),
        F.lit(known.empty).alias("store_empty"),
        F.count_if((F.col("new_cells") > 0) & ~F.col("old")).alias("new_materials"),
        F.coalesce(F.sum("moved"), zero).alias("changed_versions"),
        F.coalesce(F.sum(BUDGET), zero).alias("changed_budget_cells"),
        F.coalesce(F.sum(FORECAST), zero).alias("changed_forecast_cells"),
    ).withColumn("changed_shutdown_days", days.agg(F.count("*")).scalar())
    reasons = F.col("store_empty")
    for flag in ("new_materials", "changed_versions", "changed_budget_cells", "changed_forecast_cells", "changed_shutdown_days"):
        reasons = reasons | (F.col(flag) > 0)
    flags = flags.withColumn("should_load", ~F.col("version_in_use") & reasons)
    cells = per_measure.select("material_id", "measure", F.explode("changed").alias("c")).select(
        "material_id", "c.month", "measure", "c.stored_value", "c.new_value"
    )
    moved = per_measure.select("material_id", "measure", F.explode("moved").alias("version"), "stored_version")
    fresh = per_name.where((F.col("new_cells") > 0) & ~F.col("old")).select(F.col("name").alias("material_id"))
    return Decision(flags, fresh, moved, cells, days)


def _per_measure(
    new_plan: DataFrame, plan: DataFrame, dim_time: DataFrame | None, stored_digests: DataFrame | None = None
) -> DataFrame:
    """Per material and measure: how many new cells, the changed ones, new versions that are not the latest stored one.

    Without digests one pass over each side brings all cells together. With them rows are counted by version where they
    are read, and only cells of months that may have changed move one by one.
    """
    news = _news(new_plan, dim_time).select(
        *CELL, F.col("value").alias("new_value"), F.col("version").alias("new_version"), "asked"
    )
    if stored_digests is None:
        rows = _compared(news, plan)
    else:
        counted = news.groupBy(*MATERIAL, "new_version").agg(F.count("*").alias("new_rows"))
        held = plan.groupBy(*MATERIAL, "inserted_at", "version").agg(F.count("*").alias("old_rows")).select(
            *MATERIAL, F.struct("inserted_at", "version").alias("stored"), "old_rows"
        )
        changed = _changed(news, plan, _stored_pairs(new_plan, stored_digests))
        rows = counted.unionByName(held, allowMissingColumns=True).unionByName(changed, allowMissingColumns=True)
        rows = rows.repartition(*MATERIAL)
    grouped = rows.groupBy(F.trim("material_id").alias("name"), *MATERIAL).agg(
        F.coalesce(F.sum("new_rows"), F.lit(0)).alias("new_cells"),
        F.collect_list("change").alias("changed"),
        F.max(F.when(F.col("stored.version").isNotNull(), F.col("stored")))["version"].alias("stored_version"),
        (F.count("old_rows") > 0).alias("old"),
        F.collect_set("new_version").alias("versions"),
        F.count_if(F.col("new_rows").isNotNull() & F.col("new_version").isNull()).alias("nameless"),
    )
    versions = F.when(F.col("nameless") > 0, F.concat("versions", F.array(F.lit(None).cast("string")))).otherwise(F.col("versions"))
    named = grouped.withColumn("versions", versions).drop("nameless")
    return named.withColumn("moved", F.filter("versions", lambda v: ~v.eqNullSafe(F.col("stored_version"))))


def _days(new_shutdown: DataFrame, state: DataFrame, dim_time: DataFrame | None) -> DataFrame:
    """New shutdown days without a stored value of their measure, or with a different one."""
    if dim_time is not None:
        new_shutdown = new_shutdown.join(cal.key_of_day(dim_time), "day", "left_semi")
    stored = state.select(*DAY, F.col("hours").alias("stored_hours"))
    joined = new_shutdown.select(*DAY, F.col("hours").alias("new_hours")).join(stored, DAY, "left")
    differs = F.col("stored_hours").isNull() | ~compare.is_close(F.col("stored_hours"), F.col("new_hours"))
    return joined.where(differs).select(*DAY, "stored_hours", "new_hours")
