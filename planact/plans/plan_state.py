"""The maintained state of the plan store: merged by every load, caught up with history if one was cut off."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planact import schemas
from planact.operators import state
from planact.session import stage, staging
from planact.sinks import tables as sink
from planact.sources.tables import partition_values, read_or_empty

YEAR = schemas.PART_YEAR
# A year's state is spread over so many tasks and files at most; small ones share a task.
SLOTS = 256


class StateTables:
    """Folders of the state, beside the tables it follows.

    States and the digests of the plan's are partitioned by year, digests of versions by version; the folder of a
    version says that it is merged.
    """

    def __init__(self, root: str):
        self.plan, self.shutdown = f"{root}/plan_state", f"{root}/shutdown_state"
        self.plan_digests, self.version_digests = f"{root}/plan_state_digest", f"{root}/plan_version_digest"


def _merge(
    spark: SparkSession, path: str, rows: DataFrame, latest: Callable[..., DataFrame], keys: list[str], schema: T.StructType
) -> DataFrame | None:
    """Merge rows of some loads; only the years they touch are read and written. Returns those years as they are now.

    ``keys``: of a row of the state, its day last. Rows are spread once, by the year and a hash of the first key: a task
    merges them and writes few files, in the order of the keys.
    """
    day = keys[-1]
    years = [r[0] for r in rows.select(F.year(day)).distinct().collect()]  # years of a calendar
    if not years:
        return None
    columns = [c for c in schema.fieldNames() if c != YEAR]

    def merged_of(df: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(keys[0]), F.lit(SLOTS)).alias("slot")
        spread = df.select(*columns, F.year(day).alias(YEAR), slot).repartition(YEAR, "slot")
        return latest(spread, YEAR, "slot").select(*schema.fieldNames()).sortWithinPartitions(YEAR, *keys)

    stored = read_or_empty(spark, path, schema).where(F.col(YEAR).isin(years))
    if partition_values(spark, path, YEAR) & {str(y) for y in years}:
        merged = stage(merged_of(rows.select(*columns).unionByName(stored.select(*columns))), "plan-state")
    else:
        merged = merged_of(rows)
    sink.replace_partitions(merged, path, YEAR, spread=True)
    return spark.read.schema(schema).parquet(path).where(F.col(YEAR).isin(years))


def merge(
    spark: SparkSession, tables: StateTables, plan: DataFrame, shutdown: DataFrame, versions: Iterable[str]
) -> None:
    """Merge facts of ``versions`` into the state. May be repeated: the state of equal facts is the same.

    The digests of the versions are written last, so a merge that is cut off is found and done again by ``refresh``.
    """
    with staging(spark):
        now = _merge(spark, tables.plan, plan, state.plan_state, ["material_id", "measure", "month"], schemas.PLAN_STATE)
        _merge(spark, tables.shutdown, shutdown, state.shutdown_state, ["measure", "day"], schemas.SHUTDOWN_STATE)
        if now is not None:
            sink.replace_partitions(state.digests(now, YEAR), tables.plan_digests, YEAR)
        # A row without a month for versions without plan rows: they are merged, too.
        none = spark.createDataFrame([(v,) for v in versions], "version string").select(
            "version", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.STATE_DIGEST]
        )
        own = state.digests(plan, "version").unionByName(none).select(*schemas.VERSION_DIGEST.fieldNames())
        sink.replace_partitions(own, tables.version_digests, "version")


def refresh(spark: SparkSession, tables: StateTables, plan: str, shutdown: str) -> state.Known:
    """Merge versions that history holds and the state does not; what is known of the store then.

    Versions are told from the folders that the tables are partitioned by, without reading facts.
    """
    stored, down, merged = (partition_values(spark, path, "version") for path in (plan, shutdown, tables.version_digests))
    late = sorted((stored | down) - merged)
    if late:
        facts = [read_or_empty(spark, p, s).where(F.col("version").isin(late))
                 for p, s in ((plan, schemas.PLAN_FACT), (shutdown, schemas.SHUTDOWN_FACT))]
        merge(spark, tables, *facts, late)
    return state.Known(stored, not stored and not down)


def read(spark: SparkSession, tables: StateTables) -> tuple[DataFrame, DataFrame]:
    """The states of plan and shutdown hours."""
    return (
        read_or_empty(spark, tables.plan, schemas.PLAN_STATE).drop(YEAR),
        read_or_empty(spark, tables.shutdown, schemas.SHUTDOWN_STATE).drop(YEAR),
    )


def read_digests(spark: SparkSession, tables: StateTables) -> DataFrame:
    """The digests of the state of the plan."""
    return read_or_empty(spark, tables.plan_digests, schemas.STATE_DIGEST)


def changed_months(spark: SparkSession, tables: StateTables, new_plan: DataFrame) -> DataFrame:
    """(month, measure) in which a new plan is not, cell for cell, the latest stored state."""
    return state.differing(state.digests(new_plan), read_digests(spark, tables))


def equal_versions(spark: SparkSession, tables: StateTables, new_plan: DataFrame) -> DataFrame:
    """Stored versions that hold exactly the cells of a new plan; no cell is shuffled to find them."""
    stored = read_or_empty(spark, tables.version_digests, schemas.VERSION_DIGEST).where("month is not null")
    return state.same_versions(state.digests(new_plan), stored)
