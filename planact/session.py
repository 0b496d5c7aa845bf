"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE sizes shuffle partitions, splits skewed join
# partitions and turns a shuffle join into a broadcast join once the size is known.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffles start with many small partitions, put together to this size: what a task holds does not grow
    # with the input, its tasks do.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Generated methods above this size are not compiled by the JVM; split them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A sum beyond the range of its type raises instead of wrapping.
    "spark.sql.ansi.enabled": "true",
    # A recursive query climbs with every row of a table; its depth is what is bounded.
    "spark.sql.cteRecursionRowLimit": "-1",
    # Shuffle files go with the statement that wrote them, not when the driver happens to collect garbage: intermediate
    # results that are read again are staged.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows handed to Python at once; texts may be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Settings a session takes only when it is created.
AT_START = {
    # Do not record a Python call site for every column expression built on the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "planact", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Create (or get) a session with the defaults above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **AT_START, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Put the defaults above on a session somebody else has built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Where the session names none, a local master gets a folder inside its warehouse; any other
    master is refused, because its executors would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by the cluster (master {master})")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/planact-scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, never reused folder below the shared scratch folder."""
    path = f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    for folders in _OPEN:
        folders.append(path)
    return path


# Lists of the folders made inside each open ``staging`` block, the innermost last.
_OPEN: list[list[str]] = []


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove every scratch folder made inside this block when it ends.

    For calls that write their last output inside the block. A call that hands back a DataFrame
    over staged rows stays outside of one; its folders go with the caller's block.
    """
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield
    finally:
        _OPEN[:] = [other for other in _OPEN if other is not folders]
        for path in folders:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, purpose: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of executors; used where one
    aggregate feeds several outputs, so that the large scan behind it runs once. ``path``: a ``scratch_path`` named
    before, for rows that outlive the ``staging`` block they are made in.
    """
    path = path or scratch_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
