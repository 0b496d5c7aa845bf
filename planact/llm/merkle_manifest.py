"""A Merkle manifest of a dataset, checked by a recursive query that climbs from every leaf.

Rows become leaves, leaves of one group a binary tree in the order of their ids, and the roots of the groups, in order
of their names, the leaves of the top tree. Levels are built ``STEP`` at a time: 2**STEP neighbouring nodes meet in
one place, are folded there, and every one of them is stored as a row with the siblings on its way up and a link to the
node it leads to, its parent ``STEP`` levels above (or where its tree ends). The row of a group's root leads into the top tree.

``climb`` is ``WITH RECURSIVE``: it starts from the leaf rows with the digest somebody claims, and each turn joins the
nodes reached, folds their siblings in and appends them to the proof. It takes ceil(depth / STEP) turns for the group
and as many for the top tree, so 5 at 4e10 rows.

No group is ever in one task: leaves are ranked by a range partition over (group, id) and the counts of the parts
before; a turn of the climb broadcasts the upper nodes if a count shows that they are few, and otherwise shuffles
on (node, salt), where a node with many leaves below it is stored once per ``SPLIT`` leaves, so that all leaves of the
dataset do not meet at its root.

Defined results: null fields count as ``-``. Null ids come first, then equal ids by digest; repeated rows are leaves
of their own. The null group is the first. An empty table has no root and gives no rows. Fields are taken by name;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planact.llm.common import BROADCAST_BYTES, sized
from planact.session import stage

STEP = 10
SPLIT = 1 << 16

_STARTS_BYTES = 200  # a row of a small table in a broadcast, with room to spare
_SIBLING_BYTES = 64

_NODE = (
    "tree long, size long, level int, idx long, row long, hash string, below long, "
    "siblings array<binary>, up int, top string, top_below long"
)
_FOLD = """aggregate(transform({n}.siblings, (s, i) -> named_struct('d', lower(hex(s)), 'left', (shiftright({n}.idx, i) & 1) = 1)),
    {acc}, (acc, x) -> sha2(CASE WHEN x.left THEN concat(x.d, acc) ELSE concat(acc, x.d) END, 256))"""
_PATH = "aggregate({n}.siblings, X'', (a, s) -> concat(a, s))"


def digest(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each as its length in bytes and its text, or ``-`` if null."""

    def one(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[one(f) for f in fields]), 256)


def levels(size: Column) -> Column:
    """Levels above the leaves until one node is left: the bits of size - 1."""
    return F.when(size <= 1, 0).otherwise(F.length(F.bin(size - 1))).cast("int")


@dataclass
class Manifest:
    """``leaves`` and ``nodes`` are written tables of parent-linked rows; ``root`` is None for no rows at all."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _ranked(leaves: DataFrame) -> DataFrame:
    """(tree, size, level, idx, row, hash, below): leaves by their place in their group's tree.

    Equal leaves are told apart by the place they were written at, so that no value of the range key repeats.
    """
    order = ["grp", "id", "leaf", "row"]
    ordered = leaves.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stage(ordered.withColumn("place", F.monotonically_increasing_id()), "manifest-order")
    part = F.shiftright("place", 33)
    found = ordered.groupBy(part.alias("part"), "grp").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    found = stage(found, "manifest-parts")  # a row per part, and one per group more
    groups = found.groupBy("grp").agg(F.sum("n").alias("size"))
    trees = groups.withColumn("tree", F.row_number().over(Window.orderBy(F.col("grp").asc_nulls_first())).cast("long"))
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part")) - F.col("n")
    starts = found.withColumn("before", before).alias("a").join(trees.alias("b"), F.expr("a.grp <=> b.grp")).select(
        F.col("part").alias("s_part"), F.col("a.grp").alias("s_grp"), "first", "before", "tree", "size"
    )
    starts = sized(stage(starts, "manifest-starts"), _STARTS_BYTES)
    same = (part == F.col("s_part")) & F.col("grp").eqNullSafe(F.col("s_grp"))
    return ordered.join(starts, same).select(
        "tree", "size", F.lit(0).alias("level"), (F.col("place") - F.col("first") + F.col("before")).alias("idx"),
        "row", F.col("leaf").alias("hash"), F.lit(1).cast("long").alias("below"),
    )


def _folded(step: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        n, level, size = len(frame), int(frame["level"].iloc[0]), int(frame["size"].iloc[0])
        up = min(step, (size - 1).bit_length() - level)
        nodes = frame["hash"].tolist()
        siblings = [[] for _ in range(n)]
        for turn in range(up):
            for i in range(n):
                other = (i >> turn) ^ 1
                siblings[i].append(bytes.fromhex(nodes[other]) if other < len(nodes) else b"")
            nodes = [hashlib.sha256("".join(nodes[i : i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]
        return frame.assign(siblings=siblings, up=up, top=[nodes[0]] + [None] * (n - 1), top_below=frame["below"].sum())

    return run


def _tree(nodes: DataFrame, deepest: int, step: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels from ``nodes`` up, each with its siblings, and the roots (tree, hash, below)."""
    built, roots = [], None
    for at in range(0, max(1, deepest), step):
        meet = F.shiftright("idx", step)  # 2**step neighbours
        done = stage(nodes.groupBy("tree", meet.alias("meet")).applyInPandas(_folded(step), _NODE), f"manifest-level-{at}")
        built.append(done)
        tops = done.where("top is not null").select(
            "tree", "size", (F.col("level") + F.col("up")).alias("level"), F.shiftright("idx", step).alias("idx"),
            F.lit(None).cast("long").alias("row"), F.col("top").alias("hash"), F.col("top_below").alias("below"),
        )
        whole = F.col("level") >= levels(F.col("size"))
        ended = tops.where(whole).select("tree", "hash", "below")
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = tops.where(~whole)
    return built, roots


def _linked(nodes: DataFrame) -> DataFrame:
    """Node rows with the link to their parent; the root of a group leads into the top tree, tree 0."""
    level, tree = F.col("level") + F.col("up"), F.col("tree")
    ends = level >= levels(F.col("size"))
    return nodes.select(
        "tree", "level", "idx", "row", "hash", "below", "siblings",
        F.when(~ends, tree).when(tree > 0, 0).cast("long").alias("p_tree"),
        F.when(~ends, level).when(tree > 0, 0).cast("int").alias("p_level"),
        F.when(~ends, F.expr("shiftright(idx, up)")).when(tree > 0, tree - 1).cast("long").alias("p_idx"),
        F.col("top_below").alias("p_below"),
    )


def build(leaves: DataFrame, step: int = STEP) -> Manifest:
    """The manifest of ``leaves`` (grp, id, leaf, and whatever else shall be at hand in the climb)."""
    leaves = stage(leaves.withColumn("row", F.monotonically_increasing_id()), "manifest-leaves")
    ranked = stage(_ranked(leaves), "manifest-ranked")
    deepest = ranked.agg(F.coalesce(F.max(levels(F.col("size"))), F.lit(0)).alias("deep")).first().deep
    built, subroots = _tree(ranked, deepest, step)
    subroots = stage(subroots, "manifest-subroots")
    trees = subroots.count()
    top = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"), F.lit(0).alias("level"),
        (F.col("tree") - 1).alias("idx"), F.lit(None).cast("long").alias("row"), "hash", "below",
    )
    above, roots = _tree(top, max(0, trees - 1).bit_length(), step)
    root = roots.first()
    linked = [_linked(n) for n in built + above]
    nodes = linked[1]
    for more in linked[2:]:
        nodes = nodes.unionByName(more)
    first = linked[0].drop("hash", "below").join(leaves, "row")
    return Manifest(stage(first, "manifest-leaf-rows"), stage(nodes, "manifest-nodes"), root.hash if root else None)


def climb(manifest: Manifest, claimed: str = "leaf", split: int = SPLIT, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(row, subroot, proof, folded): what the ``claimed`` digest of every leaf folds to, its siblings as raw bytes."""
    nodes = manifest.nodes
    taken = nodes.agg(F.coalesce(F.sum(F.size("siblings") * _SIBLING_BYTES + _STARTS_BYTES), F.lit(0))).first()[0]
    if taken <= broadcast_bytes:
        hint, salt = "/*+ BROADCAST(n) */", "CAST(0 AS BIGINT)"
        nodes = nodes.withColumn("salt", F.lit(0).cast("long"))
    else:
        # A node is there once for every ``split`` leaves below it; the row of its child knows how often.
        hint, salt = "", f"pmod({{c}}.row, cast(ceil({{n}}.p_below / {split}) as bigint))"
        copies = F.ceil(F.col("below") / split).cast("long")
        nodes = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    query = f"""
        WITH RECURSIVE climb AS (
            SELECT l.row, l.p_tree, l.p_level, l.p_idx, {salt.format(c="l", n="l")} AS salt, CAST(NULL AS STRING) AS subroot,
                   {_PATH.format(n="l")} AS proof, {_FOLD.format(n="l", acc=f"l.`{claimed}`")} AS folded
            FROM {{leaves}} l
            UNION ALL
            SELECT {hint} c.row, n.p_tree, n.p_level, n.p_idx, {salt.format(c="c", n="n")} AS salt,
                   CASE WHEN n.tree = 0 AND n.level = 0 THEN n.hash ELSE c.subroot END AS subroot,
                   concat(c.proof, {_PATH.format(n="n")}) AS proof, {_FOLD.format(n="n", acc="c.folded")} AS folded
            FROM climb c JOIN {{nodes}} n
                ON c.p_tree = n.tree AND c.p_level = n.level AND c.p_idx = n.idx AND c.salt = n.salt
        )
        SELECT row, subroot, proof, folded FROM climb WHERE p_tree IS NULL
    """
    return stage(manifest.leaves.sparkSession.sql(query, leaves=manifest.leaves, nodes=nodes), "manifest-climb")


def verified(docs: DataFrame, fields: list[Column], claimed: list[Column], id_col: str, group_col: str,
             step: int = STEP, **settings) -> DataFrame:
    """(id, grp, leaf, claimed, subroot, root, proof, folded_root, verified): one row per row of ``docs``.

    ``fields`` make the leaf that the manifest holds, ``claimed`` the one that is put to the test.
    """
    leaves = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
        digest(fields).alias("leaf"), digest(claimed).alias("claimed"),
    )
    manifest = build(leaves, step)
    up = climb(manifest, "claimed", **settings)
    root = F.lit(manifest.root).cast("string")
    return manifest.leaves.select("row", "id", "grp", "leaf", "claimed").join(up, "row").select(
        "id", "grp", "leaf", "claimed", "subroot", root.alias("root"), "proof",
        F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"),
    )
