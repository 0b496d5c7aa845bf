"""Daily series of materials as runs: (from_day, to_day, value), and back.

A dense series has a row for every material and day, most of them 0 or the same as the day before. Its runs are as many as
its changes, so the whole history fits where the dense form only fits a month. Gaps are runs of 0. Everything
is grouped by material once; a material's rows are at most the days of the interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = ["from_day", "to_day"]


def coded(moved: DataFrame, everyone: DataFrame, first: Column, last: Column, value: str, key: str = "material_id") -> DataFrame:
    """The runs of every key of ``everyone`` (unique) from ``first`` to ``last``.

    ``moved``: at most one row per key and day with ``day`` and ``value``; days without a row are 0.
    """
    zero = F.lit(0).cast(moved.schema[value].dataType)
    by_day = Window.partitionBy(key).orderBy("day")
    marked = moved.where((F.col(value) != zero) & F.col("day").between(first, last)).select(key, "day", value)
    goes_on = (F.lag("day").over(by_day) == F.date_sub("day", 1)) & (F.lag(value).over(by_day) == F.col(value))
    marked = marked.withColumn("starts", F.when(goes_on, 0).otherwise(1))
    numbered = marked.withColumn("run", F.sum("starts").over(by_day))
    islands = numbered.groupBy(key, "run").agg(
        F.min("day").alias("from_day"), F.max("day").alias("to_day"), F.first(value).alias(value)
    )
    # Every island brings the gap before it; the last one also the gap behind it.
    by_run = Window.partitionBy(key).orderBy("from_day")
    before = F.coalesce(F.date_add(F.lag("to_day").over(by_run), 1), first)
    behind = F.lead("from_day").over(by_run).isNull()

    def span(begin: Column, end: Column, amount: Column) -> Column:
        return F.struct(begin.alias("from_day"), end.alias("to_day"), amount.alias(value))

    spans = islands.select(
        key,
        F.array(
            span(before, F.date_sub("from_day", 1), zero),
            span(F.col("from_day"), F.col("to_day"), F.col(value)),
            span(F.when(behind, F.date_add("to_day", 1)), F.when(behind, last), zero),
        ).alias("spans"),
    )
    opened = spans.select(key, F.inline(F.filter("spans", lambda s: s["from_day"] <= s["to_day"])))
    joined = everyone.join(opened, key, "left")
    return joined.select(
        *[F.col(c) for c in everyone.columns],
        F.coalesce("from_day", first).alias("from_day"),
        F.coalesce("to_day", last).alias("to_day"),
        F.coalesce(value, zero).alias(value),
    )


def decoded(runs: DataFrame, first: Column, last: Column) -> DataFrame:
    """The dense rows of an interval: only runs that reach into it are opened, and only as far as it goes."""
    rest = [c for c in runs.columns if c not in SPAN]
    inside = runs.where((F.col("from_day") <= last) & (F.col("to_day") >= first))
    days = F.sequence(F.greatest("from_day", first), F.least("to_day", last), F.expr("INTERVAL '1' DAY"))
    return inside.select(F.explode(days).alias("day"), *rest)
