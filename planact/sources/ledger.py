"""The ledger of files already loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_ledger(spark: SparkSession, path: str) -> DataFrame:
    """An existing ledger, one JSON array of names, as rows ``source_file``."""
    text = spark.read.option("wholetext", True).text(path)
    names = F.from_json("value", "array<string>")
    return text.select(F.explode(names).alias("source_file")).distinct()


def pending_rows(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of files the ledger does not name.

    The ledger side is one short name per file ever loaded; the optimizer broadcasts it while
    it is small and shuffles otherwise, where a file that dominates is split as a skewed key.
    """
    return rows.join(ledger.select("source_file").distinct(), "source_file", "left_anti")


def names_of(rows: DataFrame) -> DataFrame:
    return rows.select("source_file").distinct()
