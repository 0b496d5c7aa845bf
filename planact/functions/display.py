"""Text rendering; only ever the last projection of a report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def german_day(day: Column) -> Column:
    return F.date_format(day, "dd.MM.yyyy")


def whole(value: Column) -> Column:
    return F.bround(value, 0).cast("decimal(38,0)").cast("string")


def percent(value: Column, known: Column) -> Column:
    """``12.3 %``; a bare ``0 %`` where there is nothing to take a share of."""
    return F.when(known, F.concat(F.bround(value, 1).cast("decimal(38,1)").cast("string"), F.lit(" %"))).otherwise(
        F.lit("0 %")
    )


def tons(value: Column) -> Column:
    return F.concat(whole(value), F.lit(" t"))
