"""Stored Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType, *columns: str) -> DataFrame:
    """A stored table with an explicit schema, reduced to the columns asked for."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written below ``path``."""
    try:
        spark.read.schema("x INT").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write below ``path`` came to its end; an interrupted one leaves a folder without the mark."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def partition_values(spark: SparkSession, path: str, column: str) -> frozenset[str]:
    """The values a stored table is partitioned by, from the names of its folders; nothing is read."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return frozenset()
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return frozenset(unescape(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows before its first load."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
