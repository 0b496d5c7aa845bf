"""The plan as it was known at many times at once.

Every stored value is dealt to the first of the asked times that is not before it, so the times cut history into as many
stretches as there are times. A cell keeps one candidate per stretch, chosen on the map side; what was known at a time is the
latest candidate of the stretches up to it. One pass over history answers all times, and no row meets a range of others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.operators.change import CELL


def plan_as_known(plan_fact: DataFrame, times: Sequence[dt.datetime | str]) -> DataFrame:
    """(known_at, material_id, month, measure, value, version): the latest value of every cell at each time.

    Rows stored at a time are known at it. Cells without a value at a time have no row for it; equal times count once.
    """
    if not times:
        return _nothing(plan_fact)
    asked = sorted({dt.datetime.fromisoformat(t) if isinstance(t, str) else t for t in times})
    literal = F.array(*[F.lit(t.isoformat(" ")).cast("timestamp_ntz") for t in asked])
    stretch = F.size(F.filter(literal, lambda t: t < F.col("inserted_at")))
    dealt = plan_fact.where(F.col("value").isNotNull() & F.col("material_id").isNotNull()).withColumn("stretch", stretch)
    best = dealt.where(F.col("stretch") < len(asked)).groupBy(*CELL, "stretch").agg(
        F.max(F.struct("inserted_at", "value", "version")).alias("latest")
    )
    # A stretch is there once, so nothing is gained by lists before the shuffle.
    cells = best.repartition(*CELL).groupBy(*CELL).agg(F.collect_list(F.struct("stretch", "latest")).alias("held"))  # one per time at most
    known = F.transform(
        F.sequence(F.lit(0), F.lit(len(asked) - 1)),
        lambda i: F.struct(
            F.get(literal, i).alias("known_at"),
            F.array_max(F.transform(F.filter("held", lambda h: h["stretch"] <= i), lambda h: h["latest"])).alias("latest"),
        ),
    )
    opened = cells.select(*CELL, F.inline(known)).where(F.col("latest").isNotNull())
    return opened.select("known_at", *CELL, "latest.value", "latest.version")


def _nothing(plan_fact: DataFrame) -> DataFrame:
    empty = plan_fact.select(F.col("inserted_at").alias("known_at"), *CELL, "value", "version")
    return empty.where(F.lit(False))


def totals_as_known(plan_fact: DataFrame, times: Sequence[dt.datetime | str]) -> DataFrame:
    """(known_at, month, measure, total): the plan of all materials as a report made at each time would have shown it."""
    known = plan_as_known(plan_fact, times)
    return known.groupBy("known_at", "month", "measure").agg(F.sum("value").alias("total"))
