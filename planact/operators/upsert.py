"""Upsert and insert-if-absent as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source rows written over it by key; the source must be unique by key.

    Null keys never match: such source rows are inserted, such target rows are kept.
    """
    keys = list(keys)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("__t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in target.columns], F.lit(True).alias("__s"))
    on = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    merged = t.join(s, on, "full_outer")
    from_source = F.col("__s").isNotNull()
    return merged.select(
        *[
            F.when(from_source, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")
