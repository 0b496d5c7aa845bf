"""Report folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from planact.operators import calendar as cal
from planact.session import remove


def report_path(folder: str, start: cal.DateLike, end: cal.DateLike) -> str:
    return f"{folder.rstrip('/')}/Report_{cal.as_date(start)}_{cal.as_date(end)}"


def write_report(
    folder: str,
    start: cal.DateLike,
    end: cal.DateLike,
    params: DataFrame,
    parts: dict[str, DataFrame],
    fmt: str = "parquet",
) -> dict[str, str]:
    """Write the parameter block and every part that has rows; returns the folders written."""
    base = report_path(folder, start, end)
    spark = params.sparkSession
    written = {}
    for name, part in parts.items():
        path = f"{base}/{name}"
        options = {"header": "true"} if fmt == "csv" else {}
        part.write.mode("overwrite").format(fmt).options(**options).save(path)
        back = spark.read.format(fmt).options(**options).schema(part.schema).load(path)
        if back.isEmpty():
            for left in (path, f"{base}/{name}_params"):
                remove(spark, left)
            continue
        params.write.mode("overwrite").format(fmt).options(**options).save(f"{base}/{name}_params")
        written[name] = path
    return written
