"""Parquet tables: append, insert-if-absent, upsert.

Facts are partitioned by month, so that a report reads one partition and an upsert rewrites
only the months it touches. An upsert never reads the folder it is writing: the merged rows are
written elsewhere first, then put in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planact import schemas
from planact.operators import calendar as cal
from planact.operators import dedupe, keyfilter, upsert
from planact.session import stage, staging
from planact.sources.tables import exists, partition_values, read_or_empty

MONTH = schemas.PART_MONTH
#: Rows that an append of movements shuffles at once.
ROWS_AT_ONCE = 32_000_000


def month_of(column: str) -> Column:
    return F.to_date(F.trunc(F.col(column), "MM"))


def append_by_month(df: DataFrame, column: str, path: str) -> int:
    """Append, partitioned by the month of ``column``; how many rows there were.

    Rows are spread by adaptive rebalancing on the month: small months share a task and a
    month that holds most of the rows is split over several, instead of one writer per month.
    """
    written = Observation("appended")
    parted = df.withColumn(MONTH, month_of(column)).hint("rebalance", MONTH)
    parted.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(MONTH).parquet(path)
    return written.get["rows"]


def append_telemetry(df: DataFrame, path: str) -> int:
    return append_by_month(df, "ts", path)


def append_movements(spark: SparkSession, cleaned: DataFrame, path: str) -> int:
    """Append movements whose document and posting day are not stored yet; how many were appended.

    Filters of the stored keys, one per month beside the table, tell which rows cannot be stored. Stored keys are
    read only for the rest, and only of the months these fall into. A filter takes the rows in before the table
    does: after an interruption it holds too many keys, which costs a look, never too few. Every append
    goes through here; a month without a filter, as an older table has, gets one from its stored keys.
    """
    return append_movements_counted(spark, cleaned, path)[0]


def append_movements_counted(spark: SparkSession, cleaned: DataFrame, path: str) -> tuple[int, int]:
    """As ``append_movements``; also how many rows had to be looked up among the stored keys.

    Filters and stored keys are asked by the keys of the batch alone: its rows move once, into the table, and by
    ``ROWS_AT_ONCE``. All rows of a key are appended together, so that an interrupted append can be repeated.
    """
    with staging(spark):
        rows = cleaned.withColumn(MONTH, month_of("BucDat"))
        sizes = {r[0]: r[1] for r in rows.groupBy(MONTH).count().collect()}  # months of one load
        total = sum(sizes.values())
        sizes.pop(None, None)
        known = partition_values(spark, path, MONTH)
        filters = _month_filters(spark, path, {m: n for m, n in sizes.items() if str(m) in known})
        looked_up, added = 0, rows
        if filters is not None:
            seen = Observation("asked")
            keys = rows.select(F.trim("BpzIdt").alias("BpzIdt"), "BucDat", MONTH)
            flagged = keyfilter.marked(keys, filters, MONTH, _key(), "__maybe")
            flagged = stage(flagged.observe(seen, F.count_if("__maybe").alias("n")), "movement-keys")
            looked_up, added = seen.get["n"], flagged.where("not __maybe").drop("__maybe")
            if looked_up:
                maybe = flagged.where("__maybe").select(F.col("BpzIdt").alias("doc_id"), F.col("BucDat").alias("day"), MONTH)
                stored = spark.read.parquet(path).select(F.col("BpzIdt").alias("doc_id"), F.col("BucDat").alias("day"), MONTH)
                new = stage(dedupe.new_movements(maybe, stored, MONTH), "movement-new")
                fresh = new.select(F.col("doc_id").alias("BpzIdt"), F.col("day").alias("BucDat"), MONTH)
                left_out = looked_up - fresh.count()
                added = added.unionByName(fresh)
                if left_out:
                    rows = _kept(rows, flagged, fresh, added, left_out, total)
                total -= left_out
        _add_keys(spark, added, path, sizes)
        parts = max(1, -(-total // ROWS_AT_ONCE))
        part = F.pmod(F.xxhash64(F.lit(3), *_key()), F.lit(parts))
        rows = rows.drop(MONTH)
        return sum(append_by_month(rows if parts == 1 else rows.where(part == i), "BucDat", path) for i in range(parts)), looked_up


def _kept(rows: DataFrame, flagged: DataFrame, fresh: DataFrame, added: DataFrame, left_out: int, total: int) -> DataFrame:
    """The rows whose key is not stored: those of the keys to add or all but those of the stored ones, whichever are fewer.

    A row without a document or a day is never stored already.
    """
    few = left_out < total - left_out
    named = flagged.where("__maybe").drop("__maybe") if few else added
    named = named.select("BpzIdt", "BucDat").where("BpzIdt is not null and BucDat is not null").distinct()
    if few:
        named = dedupe.not_stored(named, fresh, ["BpzIdt", "BucDat"])
    named = stage(named.select(F.col("BpzIdt").alias("__doc"), F.col("BucDat").alias("__day")), "movement-named")
    doc, day = _key()
    met = rows.join(named, (doc == F.col("__doc")) & (day == F.col("__day")), "left_anti" if few else "left_semi")
    return met if few else met.unionByName(rows.where(doc.isNull() | day.isNull()))


def _key() -> list[Column]:
    return [F.trim("BpzIdt"), F.col("BucDat")]


def _keys(path: str) -> str:
    return path.rstrip("/") + "_keys"


def _month_filters(spark: SparkSession, path: str, sizes: dict) -> DataFrame | None:
    """The filters of stored months; one that is missing, or too full with the new rows, is built from the stored keys."""
    if not sizes:
        return None
    months = [F.lit(str(m)).cast("date") for m in sizes]
    filters = read_or_empty(spark, _keys(path), schemas.KEY_FILTER).where(F.col(MONTH).isin(months))
    held = {r[0]: r for r in filters.groupBy(MONTH).agg(F.sum("keys"), F.max("blocks")).collect()}
    short = {m for m, n in sizes.items() if m not in held or (held[m][1] + n) > keyfilter.FULL * held[m][2]}
    if short:
        stored = spark.read.parquet(path).where(F.col(MONTH).isin([F.lit(str(m)).cast("date") for m in short]))
        stored = stored.select("BpzIdt", "BucDat", MONTH)
        counts = {r[0]: r[1] for r in stored.groupBy(MONTH).count().collect()}
        wide = _wide({m: counts.get(m, 0) + sizes[m] for m in short})
        built = keyfilter.summed(stored, MONTH, _key(), wide)
        replace_partitions(built.select(*schemas.KEY_FILTER.fieldNames()), _keys(path), MONTH)
        filters = read_or_empty(spark, _keys(path), schemas.KEY_FILTER).where(F.col(MONTH).isin(months))
    return filters


def _wide(sizes: dict) -> Column:
    """How many blocks each month gets."""
    wide = F.lit(1)
    for month, n in sizes.items():
        wide = F.when(F.col(MONTH) == F.lit(str(month)).cast("date"), keyfilter.blocks_for(n)).otherwise(wide)
    return wide


def _add_keys(spark: SparkSession, rows: DataFrame, path: str, sizes: dict) -> None:
    """Take the keys of new rows into the filters of their months."""
    months = [F.lit(str(m)).cast("date") for m in sizes]
    if not months:
        return
    old = read_or_empty(spark, _keys(path), schemas.KEY_FILTER).where(F.col(MONTH).isin(months))
    held = {r[0]: r[1] for r in old.groupBy(MONTH).agg(F.max("blocks")).collect()}
    wide = _wide({m: n for m, n in sizes.items() if m not in held})
    for month, blocks in held.items():
        wide = F.when(F.col(MONTH) == F.lit(str(month)).cast("date"), blocks).otherwise(wide)
    new = keyfilter.summed(rows.where(F.col(MONTH).isNotNull()), MONTH, _key(), wide)
    both = keyfilter.merged(new.unionByName(old.select(*new.columns)), MONTH)
    replace_partitions(stage(both.select(*schemas.KEY_FILTER.fieldNames()), "key-filters"), _keys(path), MONTH)


def _stamped(rows: DataFrame) -> DataFrame:
    return rows if "inserted_at" in rows.columns else rows.withColumn("inserted_at", F.localtimestamp())


def append_plan(rows: DataFrame, path: str) -> None:
    """Append plan rows, stamped with one load time unless they are already.

    Partitioned by version, which every report and check names, and sorted by month inside,
    so that a report reads one version and skips row groups of other months.
    """
    stamped = _stamped(rows).select(*schemas.PLAN_FACT.fieldNames())
    stamped.sortWithinPartitions("version", "month").write.mode("append").partitionBy("version").parquet(path)


def append_shutdown(rows: DataFrame, path: str) -> None:
    stamped = _stamped(rows).select(*schemas.SHUTDOWN_FACT.fieldNames())
    stamped.sortWithinPartitions("version", "day").write.mode("append").partitionBy("version").parquet(path)


def append_missing_members(spark: SparkSession, path: str, members: DataFrame) -> None:
    """Add calendar members that are not stored yet."""
    stored = read_or_empty(spark, path, schemas.TIME_MEMBER)
    months, days = members.where("is_month"), members.where("not is_month")
    # Months first: a day added later must not stand in for the month's own member.
    stage(cal.missing_members(stored, months), "time-months").write.mode("append").parquet(path)
    stored = spark.read.schema(schemas.TIME_MEMBER).parquet(path)
    stage(cal.missing_members(stored, days), "time-days").write.mode("append").parquet(path)


def upsert_table(
    spark: SparkSession, path: str, schema: T.StructType, source: DataFrame, keys: Sequence[str]
) -> None:
    """Upsert a whole table; ``source`` must be unique by key.

    The merged rows are written beside the table and take its place by renaming. A table whose
    replacement was interrupted is put right by the next call, before anything is read.
    """
    recover(spark, path)
    merged = upsert.upsert(read_or_empty(spark, path, schema), source, keys)
    replace_table(spark, merged, path)


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, lambda suffix: jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + suffix)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write ``df``, which may read the table, and put it in the table's place."""
    df.write.mode("overwrite").parquet(path.rstrip("/") + ".new")
    fs, named = _files(spark, path)
    if fs.exists(named("")):
        fs.rename(named(""), named(".old"))
    fs.rename(named(".new"), named(""))
    fs.delete(named(".old"), True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo an interrupted replacement: the table itself wins, then the complete old one."""
    fs, named = _files(spark, path)
    if not fs.exists(named("")) and fs.exists(named(".old")):
        fs.rename(named(".old"), named(""))
    for suffix in (".old", ".new"):
        if fs.exists(named(suffix)):
            fs.delete(named(suffix), True)


def replace_partitions(merged: DataFrame, path: str, partition: str, spread: bool = False) -> None:
    """Put rows in place of the partitions they belong to; the others stay. ``merged`` must not read ``path``.

    ``spread``: its rows are spread over tasks by partition already and are written as they are.
    """
    (
        (merged if spread else merged.hint("rebalance", partition)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def upsert_partitions(
    spark: SparkSession, path: str, schema: T.StructType, source: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Upsert into a table partitioned by ``partition``, which must follow from the key.

    Only partitions the source touches are read and replaced; the others stay as they are. The source
    is written first: it may be a stateful micro-batch, and is evaluated once.
    """
    with staging(spark):
        source = stage(source.select(*schema.fieldNames()), "upsert-source")
        if not exists(spark, path):
            source.write.partitionBy(partition).parquet(path)
            return
        touched = dedupe.touched_partitions(source, F.col(partition), partition)
        target = spark.read.schema(schema).parquet(path).join(touched, partition, "left_semi")
        merged = stage(upsert.upsert(target.select(*schema.fieldNames()), source, keys), "upsert")
        (
            merged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
