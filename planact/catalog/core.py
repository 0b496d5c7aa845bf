"""Registration of named queries, and how their results are handed over."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None


CATALOG: dict[str, Entry] = {}


def plain(df: DataFrame) -> DataFrame:
    """Numbers as DOUBLE or integers, days as ISO text: the same values in any client."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("int")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with its SQL counterpart, if there is one."""

    def register(run: Run) -> Run:
        if name in CATALOG:
            raise KeyError(f"query {name} is registered twice")
        CATALOG[name] = Entry(lambda spark, sf_dir: plain(run(spark, sf_dir)), sql)
        return run

    return register
