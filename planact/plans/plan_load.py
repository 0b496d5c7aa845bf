"""Loading a plan workbook: dimension, calendar, decision, facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from planact import schemas
from planact.operators import calendar as cal
from planact.operators import change, quality, state
from planact.operators.plan import BUDGET
from planact.plans import plan_state
from planact.session import stage
from planact.sinks import tables as sink
from planact.sources import grids
from planact.sources.tables import read_or_empty


@dataclass(frozen=True)
class PlanStore:
    """Folders of the stored tables."""

    root: str

    @property
    def materials(self) -> str:
        return f"{self.root}/dim_material"

    @property
    def time(self) -> str:
        return f"{self.root}/dim_time"

    @property
    def plan(self) -> str:
        return f"{self.root}/plan_fact"

    @property
    def shutdown(self) -> str:
        return f"{self.root}/shutdown_fact"

    @property
    def state(self) -> plan_state.StateTables:
        return plan_state.StateTables(self.root)


def plan_fact_rows(new_plan: DataFrame, materials: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Rows to store: known materials, known months, empty cells as 0."""
    known = quality.known_materials(new_plan, materials).join(cal.key_of_month(dim_time), "month", "left_semi")
    return _stored_columns(known)


def _stored_columns(known: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return known.select(
        "version", "material_id", "month", "measure", F.coalesce(F.col("value"), zero).alias("value")
    )


def _known_rows(new_plan: DataFrame, materials: DataFrame, dim_time: DataFrame, counts: Observation) -> DataFrame:
    """As ``plan_fact_rows``; ``counts`` observes, in the pass that writes them, what is left out and why."""
    ids = materials.select("material_id", F.lit(True).alias("known_id")).distinct()
    months = cal.key_of_month(dim_time).select("month", F.lit(True).alias("known_month"))
    marked = new_plan.join(ids, "material_id", "left").join(months, "month", "left")
    no_id, no_month = F.col("known_id").isNull(), F.col("known_month").isNull()
    observed = marked.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(no_id).alias("unknown_material"),
        F.count_if(~no_id & no_month).alias("unknown_month"),
        F.count_if(~no_id & ~no_month & F.col("value").isNull()).alias("empty_cells"),
    )
    return _stored_columns(observed.where(~no_id & ~no_month))


def shutdown_fact_rows(new_shutdown: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Shutdown rows whose day the calendar knows."""
    return new_shutdown.join(cal.key_of_day(dim_time), "day", "left_semi").select("version", "day", "measure", "hours")


def load_workbook(
    spark: SparkSession,
    sheets: dict[str, str],
    store: PlanStore,
    years: Sequence[int] | None = None,
) -> change.Decision:
    """Load one landed workbook into the store if the decision says so.

    Without ``years`` every month column is loaded; ``grids.months_left_out`` tells what a list keeps out.

    ``sheets`` names the folders of the four sheets: budget, forecast, budget_shutdown,
    forecast_shutdown. Everything is checked before the first write.
    """
    book = grids.read_workbook(spark, **sheets, years=years)
    found = stage(book["materials"], "sheet-materials")
    quality.require_categories(found)
    sink.upsert_table(spark, store.materials, schemas.MATERIAL, found, ["material_id"])

    # The sheets are wide text; their long form is written once and feeds every check below.
    new_plan = stage(book["budget"].unionByName(book["forecast"]), "new-plan")
    new_shutdown = book["budget_shutdown"].unionByName(book["forecast_shutdown"])
    members = cal.month_members(new_plan.where(F.col("measure") == BUDGET)).unionByName(cal.day_members(book["forecast_shutdown"]))
    sink.append_missing_members(spark, store.time, members)

    materials = spark.read.schema(schemas.MATERIAL).parquet(store.materials)
    dim_time = spark.read.schema(schemas.TIME_MEMBER).parquet(store.time)
    # The state is that of all stored loads; what is new is compared with it, not with history.
    known = plan_state.refresh(spark, store.state, store.plan, store.shutdown)
    decision = state.decision(
        new_plan, book["budget_shutdown"], *plan_state.read(spark, store.state), known, dim_time,
        plan_state.read_digests(spark, store.state),
    )
    if not decision.should_load():
        return decision
    counts, stamp = Observation("plan-load"), F.localtimestamp().alias("inserted_at")
    facts = stage(_known_rows(new_plan, materials, dim_time, counts).select("*", stamp), "plan-facts")
    down = stage(shutdown_fact_rows(new_shutdown, dim_time).select("*", stamp), "shutdown-facts")
    sink.append_plan(facts, store.plan)
    sink.append_shutdown(down, store.shutdown)
    versions = {r["version"] for r in new_plan.select("version").distinct().collect()}  # those of one workbook
    plan_state.merge(spark, store.state, facts, down, versions)
    return replace(decision, counts=dict(counts.get))


def load_catalogue(spark: SparkSession, path: str, table: str) -> None:
    """Append the second material catalogue."""
    grids.read_catalogue(spark, path).write.mode("append").parquet(table)
