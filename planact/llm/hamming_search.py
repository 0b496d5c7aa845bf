"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: the signs of their coordinates in a learned rotation (iterative
quantisation on a bounded sample, ``SAMPLE`` vectors with the smallest hash of their id). A code is
split into ``SUBSTRINGS`` substrings, each indexed by its value. Codes within a Hamming radius r of a
query agree with it in some substring up to floor(r / SUBSTRINGS) bits (pigeonhole), so probing every
value that near in every substring retrieves all codes within r; their vectors are then ranked by
inner product. The radius is learned too: it holds ``COVERAGE`` of the true neighbours of a sample. Queries
that find fewer than they ask for in it ask again with twice the radius, at last with all bits, which reaches every row.

The index is dealt over shards of ``SHARD_ROWS`` rows, and every block of queries visits every shard;
each keeps its nearest, and an aggregation keeps the nearest of all. A hot vector's copies are dealt
over the shards like any rows, so no group gathers. All rows are indexed and no bucket is cut.

Neighbours of vectors without structure lie at almost half of the bits. Probing then reads much of the
index, and the cost per query follows the rows; see the README for measured figures.

Defined results: vectors that are null or zero, or hold null, infinite or undefined components, take
no part, and neither do vectors of another length than the most frequent one (ties: the longer). A query's
own row, by id, is no candidate; rows with equal ids are one another's own. Ties go to the smaller id. Fewer candidates
than asked for are all returned. Null ids take no part. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import col
from planact.session import stage

NEAREST = 20
EVERY = 20
SUBSTRINGS = 8
SAMPLE = 4096
SAMPLE_QUERIES = 256
COVERAGE = 0.98
SHARD_ROWS = 16_384
QUERY_BLOCK = 4_096
ITERATIONS = 20


@dataclass
class Codes:
    """A rotation to ``8 * SUBSTRINGS`` bits and the radius that neighbours lie in."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """One byte per substring."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def learn(sample: np.ndarray, nearest: int = NEAREST, seed: int = 7) -> Codes:
    """Iterative quantisation (Gong and Lazebnik, 2011): alternate signs and the best rotation to them."""
    bits, dim = 8 * SUBSTRINGS, sample.shape[1]
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(0)
    centred = unit - mean
    rng = np.random.default_rng(seed)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    base = axes.T[:, : min(bits, axes.shape[0])]
    blocks = []
    while sum(b.shape[1] for b in blocks) < bits:  # fewer dimensions than bits: several rotations
        start, _ = np.linalg.qr(rng.normal(size=(base.shape[1], base.shape[1])))
        rotated = base @ start
        for _ in range(ITERATIONS):
            signs = np.where(centred @ rotated > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(base.T @ (centred.T @ signs))
            rotated = base @ (u @ vt)
        blocks.append(rotated)
    codes = Codes(mean, np.concatenate(blocks, 1)[:, :bits])
    asked = sample[: min(SAMPLE_QUERIES, len(sample))]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(nearest, len(sample) - 1)
    if k > 0:
        own = np.bitwise_count(codes.encode(_unit(asked))[:, None] ^ codes.encode(_unit(sample))[None]).sum(2)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        codes.radius = int(np.quantile(np.take_along_axis(own, best, 1), COVERAGE, method="higher"))
    return codes


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@lru_cache
def _probes(flips: int) -> np.ndarray:
    """All byte masks with at most that many bits."""
    masks = np.arange(256, dtype=np.uint8)
    return masks[np.bitwise_count(masks) <= flips]


class Shard:
    """The index of some rows: for every substring its values with the rows that have them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(SUBSTRINGS)]
        self.begin = [np.searchsorted(codes[o, s], np.arange(257)) for s, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        masks = _probes(min(8, radius // SUBSTRINGS))
        seen = np.zeros(len(self.codes), bool)
        for s in range(SUBSTRINGS):
            order, begin = self.order[s], self.begin[s]
            for value in code[s] ^ masks:
                seen[order[begin[value] : begin[int(value) + 1]]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1) <= radius]


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>): rows that can be compared."""
    found = rows.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = found.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0.0))
    return found


def fit(vectors: DataFrame, sample: int = SAMPLE, nearest: int = NEAREST, seed: int = 7) -> Codes | None:
    """Learn codes from at most ``sample`` rows; None if there are no rows."""
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toPandas()
    if not len(chosen):
        return None
    return learn(np.stack(chosen["v"].to_numpy()), nearest, seed)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def nearest_neighbours(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = EVERY,
    nearest: int = NEAREST,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``every`` its nearest rows."""
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col)
    sizes = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim = sizes[0]["n"] if sizes else 0
    vectors = vectors.where(F.size("v") == dim)
    codes = fit(vectors, sample, nearest)
    if codes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(codes)  # a matrix of dimensions x bits

    def encode(frames):
        for frame in frames:
            found = shared.value.encode(_unit(_matrix(frame["v"])))
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "code": [c.tobytes() for c in found]})

    coded = vectors.mapInPandas(encode, "vec_id long, v array<double>, code binary")
    coded = stage(coded.withColumn("row", F.monotonically_increasing_id()), "codes")
    queries = coded.where(F.pmod("vec_id", F.lit(every)) == 0)
    rows_in = coded.count()
    shards = max(1, -(-rows_in // shard_rows))
    dealt = F.xxhash64("row")

    def search(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
        asks = frame["asks"].to_numpy()
        mine, theirs = frame[~asks], frame[asks]
        empty = pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []})
        empty = empty.astype({"row": int, "query_id": int, "vec_id": int})
        if not len(mine) or not len(theirs):
            return empty
        ids, points = mine["vec_id"].to_numpy(), _matrix(mine["v"])
        code_of = lambda f: np.frombuffer(b"".join(f["code"]), np.uint8).reshape(-1, SUBSTRINGS)
        shard = Shard(code_of(mine))
        out = []
        for row, query, vector, code in zip(theirs["row"], theirs["vec_id"], _matrix(theirs["v"]), code_of(theirs)):
            near = shard.within(code, radius)
            near = near[ids[near] != query]
            score = points[near] @ vector
            if len(near) > nearest:
                least = np.partition(score, len(near) - nearest)[len(near) - nearest]
                keep = score >= least  # with all that tie for the last place
                near, score = near[keep], score[keep]
            order = np.lexsort((ids[near], -score))[:nearest]
            out.append(pd.DataFrame({"row": row, "query_id": query, "vec_id": ids[near][order], "score": score[order]}))
        return pd.concat(out) if out else empty

    def ask(left: DataFrame, radius: int) -> DataFrame:
        """(row, query_id, vec_id, score): what the rows of ``left`` find within ``radius``, the nearest of each shard."""
        blocks = max(1, -(-left.count() // query_block))
        # Every pair of a shard and a block of queries is one task's share, of bounded size.
        index = coded.select(
            "row", "vec_id", "v", "code", F.lit(False).alias("asks"), F.pmod(dealt, F.lit(shards)).cast("int").alias("shard"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        )
        asked = left.select(
            "row", "vec_id", "v", "code", F.lit(True).alias("asks"),
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
        )
        pairs = index.unionByName(asked).groupBy("shard", "block")
        schema = "row long, query_id long, vec_id long, score double"
        return stage(pairs.applyInPandas(lambda frame: search(frame, radius), schema), "hits")

    enough, radius, left, found = min(nearest, rows_in - 1), codes.radius, queries, None
    while True:
        hits = ask(left, radius)
        last = radius >= 8 * SUBSTRINGS
        if not last:
            full = stage(hits.groupBy("row").count().where(F.col("count") >= enough).select("row"), "full")
            hits = hits.join(full, "row", "left_semi")
            left = stage(left.join(full, "row", "left_anti"), "left")
        found = hits if found is None else found.unionByName(hits)
        if last or left.isEmpty():
            break
        radius = min(8 * SUBSTRINGS, max(2 * radius, SUBSTRINGS))
    # At most shards x nearest rows of a query meet; the struct orders by score, then by the smaller id.
    best = found.groupBy("query_id").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("all"))
    ranked = best.select("query_id", F.posexplode(F.slice(F.sort_array("all"), 1, nearest)).alias("at", "x"))
    return ranked.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score")
    )
