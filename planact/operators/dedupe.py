"""Duplicates and rows already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def last_row_wins(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """One row per key: the one with the highest ``order``.

    An aggregate, not a window: map tasks keep one candidate per key, so a key repeated
    over and over never gathers in one task.
    """
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(order.alias("o"), *rest)) if rest else F.max(F.lit(1))
    picked = df.groupBy(*keys).agg(best.alias("r"))
    return picked.select(*[F.col(c) if c in keys else F.col("r")[c].alias(c) for c in df.columns])


def not_stored(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet; duplicates within ``new`` stay.

    The stored side is reduced to distinct keys before its shuffle. A hot key on the new
    side is split by adaptive execution: every part needs only the one stored key.
    """
    return new.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def touched_partitions(df: DataFrame, value: Column, name: str) -> DataFrame:
    """The partitions rows of ``df`` fall into, as ``name``, to be semi-joined with a stored table.

    Months are broadcast: DATE ends with the year 9999, so there are at most 120,000 of them.
    The comparison holds for every month; with it the optimizer takes the side for selective
    and turns the broadcast into a partition filter of the stored table at run time.
    """
    parts = df.select(value.alias(name))
    if isinstance(parts.schema[name].dataType, T.DateType):
        return F.broadcast(parts.where(F.col(name) >= F.lit("0001-01-01").cast("date")).distinct())
    return parts.distinct()


def new_movements(new: DataFrame, stored: DataFrame, stored_month: str | None = None) -> DataFrame:
    """Movements whose (document, posting day) is not stored; ids compare without outer blanks.

    ``stored_month`` names the month column the stored table is partitioned by; only stored
    months the batch can match are then read.
    """
    key = F.trim("doc_id")
    fresh = new.withColumn("__doc", key)
    known = stored
    if stored_month is not None:
        touched = touched_partitions(new, F.trunc("day", "MM"), stored_month)
        known = stored.join(touched, stored_month, "left_semi")
    known = known.select(key.alias("__doc"), "day")
    return not_stored(fresh, known, ["__doc", "day"]).drop("__doc").select(*new.columns)
