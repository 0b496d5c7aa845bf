"""Connected components of a large graph by alternating hooks, each round a few shuffles.

Large-star and small-star (Kiveris et al., 2014): every round joins neighbours to the smallest node
seen so far, until nothing changes. Each round's links are written to the shared folder, so the plan
of a round never holds those before it and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.session import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(pairs: DataFrame) -> DataFrame:
    """Per node ``a`` the smallest of it and its neighbours; partial minima first, so hubs do not gather."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that can be reached."""
    links = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        # Large star: neighbours above a node go to the smallest node around it. The minima are
        # written first; a hub's side of the join is then a plain shuffle that can be split.
        pairs = _both_ways(links)
        least = stage(_least(pairs), "least")
        large = pairs.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "large-star")
        # Small star: a node and its smaller neighbours go to the smallest of them (a > b holds).
        least = stage(_least(large), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("p"))
        small = small.select(F.col("p.b").alias("a"), F.col("p.m").alias("b")).where("a <> b").distinct()
        done = stage(small, "small-star")
        changed = done.exceptAll(links).limit(1).count() or links.exceptAll(done).limit(1).count()
        links = done
        if not changed:
            break
    tops = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
