"""Exact duplicates by an exchange of Golomb-coded fingerprints.

A task reads its rows in blocks of bounded size. Equal texts of a block are put together right there, by
their bytes, so a text that a third of all rows share leaves every block once. The fingerprints of a
block (the first ``PRINT_BITS`` bits of the texts' SHA-256) are sorted, cut into ``2**BUCKET_BITS``
ranges, each of which has an owner, and sent there as Golomb-coded gaps: about 4 bytes each where a
digest has 32. An owner sees which fingerprints came from several blocks and answers every message with a
bitmap, one bit a fingerprint. Only texts whose bit is set, the suspects, are shuffled: they are grouped by
their bytes, which is the verification and settles what fingerprints have in common by chance.

The texts of the blocks are written once, bucketed by block, so that the bitmaps go to them without a
shuffle of texts at any size. An owner holds rows / 2**BUCKET_BITS fingerprints at a time (16 bytes
each: 640 MB at 4e10 rows). Group sizes and the rows that stay travel back by the digest, one row per
block and text.

Defined results: null texts are empty ones; texts are equal if they are so byte by byte (after
``normal``, if that is given). The row with the largest doc_id stays; a null doc_id is below all
others. Of rows with equal id and text one stays. Two different texts with one SHA-256 raise an error. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts, sized, within, without
from planact.session import remove, scratch_path, stage

PRINT_BITS = 48
BUCKET_BITS = 10
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 32 << 20

_LOCAL = (
    "block long, bucket int, nth int, sha binary, text string, copies long, keep long, "
    "members array<struct<doc_id:long,key:long>>, messages array<struct<bucket:int,n:int,k:int,bits:binary>>"
)
_LABEL_BYTES = 200  # a label in a broadcast table, with room to spare


def golomb(values: np.ndarray, width: int) -> tuple[int, bytes]:
    """(k, code) of sorted distinct values below ``width``: gaps by a Golomb code of parameter 2**k.

    All quotients stand in front, in unary, all remainders of k bits behind, so both are read as arrays.
    """
    n = len(values)
    k = max(0, int(np.floor(np.log2(max(1.0, 0.6931 * width / n)))))
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    quotients = gaps >> k
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    rest = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return k, np.packbits(np.concatenate((unary, rest.ravel().astype(np.uint8)))).tobytes()


def ungolomb(n: int, k: int, code: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    stops = np.flatnonzero(bits == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    behind = int(stops[-1]) + 1
    rest = bits[behind : behind + n * k].reshape(n, k).astype(np.int64) @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum((quotients << k) + rest + 1) - 1


def _block_rows(block: int, found: dict, print_bits: int, bucket_bits: int) -> Iterator[pa.RecordBatch]:
    """The distinct texts of a block in the order of their fingerprints; the first row carries the messages."""
    texts = list(found)
    shas = [found[t][0] for t in texts]
    prints = np.array([int.from_bytes(s[:8], "big") >> (64 - print_bits) for s in shas], np.int64)
    order = np.argsort(prints, kind="stable")
    values, which = np.unique(prints[order], return_inverse=True)
    shift = print_bits - bucket_bits
    buckets = values >> shift
    begins = np.searchsorted(buckets, buckets)
    messages = []
    for at in np.unique(begins):
        end = int(np.searchsorted(buckets, buckets[at], "right"))
        k, bits = golomb(values[at:end] - (buckets[at] << shift), 1 << shift)
        messages.append({"bucket": int(buckets[at]), "n": end - int(at), "k": k, "bits": bits})
    at = 0
    while at < len(order):
        end, size = at, 0
        while end < len(order) and end - at < 1000 and (end == at or size < BLOCK_BYTES):
            size += len(texts[order[end]])
            end += 1
        part, places = order[at:end], which[at:end]
        members = [found[texts[i]][1] for i in part]
        known = [[d for d, _ in m if d is not None] for m in members]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(end - at, block, np.int64)),
                pa.array(buckets[places].astype(np.int32)),
                pa.array((places - begins[places]).astype(np.int32)),
                pa.array([shas[i] for i in part], pa.binary()),
                pa.array([texts[i] for i in part], pa.string()),
                pa.array([len(m) for m in members], pa.int64()),
                pa.array([max(k) if k else None for k in known], pa.int64()),
                pa.array(
                    [[{"doc_id": d, "key": k} for d, k in m] for m in members],
                    pa.list_(pa.struct([("doc_id", pa.int64()), ("key", pa.int64())])),
                ),
                pa.array(
                    [messages if at + i == 0 else None for i in range(end - at)],
                    pa.list_(pa.struct([("bucket", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("bits", pa.binary())])),
                ),
            ],
            names=["block", "bucket", "nth", "sha", "text", "copies", "keep", "members", "messages"],
        )
        at = end


def _blocks(print_bits: int, bucket_bits: int, block_rows: int, block_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        found: dict[str, tuple[bytes, list]] = {}
        rows = size = 0
        for batch in batches:
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                entry = found.get(text)
                if entry is None:
                    raw = text.encode()
                    entry = found[text] = (hashlib.sha256(raw).digest(), [])
                    size += len(raw)
                entry[1].append((doc_id, key))
                rows += 1
                if rows >= block_rows or size >= block_bytes:
                    yield from _block_rows(block, found, print_bits, bucket_bits)
                    block, found, rows, size = block + 1, {}, 0, 0
        if found:
            yield from _block_rows(block, found, print_bits, bucket_bits)

    return run


def _answer(batches):
    """Messages sorted by bucket -> a bitmap for every message that holds a fingerprint sent by another block too."""

    def bitmaps(bucket: int, messages: list) -> pa.RecordBatch:
        values = [ungolomb(n, k, bits) for _, n, k, bits in messages]
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        again = every[order][1:] == every[order][:-1]
        twice = np.zeros(len(every), bool)
        twice[order[1:]] |= again
        twice[order[:-1]] |= again
        ends = np.cumsum([len(v) for v in values])
        flags = [(m[0], f) for m, f in zip(messages, np.split(twice, ends[:-1])) if f.any()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([b for b, _ in flags], pa.int64()),
                pa.array([bucket] * len(flags), pa.int32()),
                pa.array([np.packbits(f, bitorder="little").tobytes() for _, f in flags], pa.binary()),
            ],
            names=["block", "bucket", "bitmap"],
        )

    held, owner = [], None
    for batch in batches:
        for bucket, *message in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != owner and held:
                yield bitmaps(owner, held)
                held = []
            owner = bucket
            held.append(message)
    if held:
        yield bitmaps(owner, held)


def _bit(bitmap: str, nth: str) -> Column:
    byte = F.conv(F.hex(F.expr(f"substring({bitmap}, {nth} div 8 + 1, 1)")), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), F.col(nth) % 8).cast("int")) > 0


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normal: Callable[[Column], Column] | None = None,
    print_bits: int = PRINT_BITS,
    bucket_bits: int = BUCKET_BITS,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, key, keep_id, group_size, kept, text_sha256): one row per row of ``docs``, a written table.

    ``key`` tells rows with one id apart, as everywhere in this package; ``normal`` may change texts
    before they are compared (the digest is that of the changed text).
    """
    spark = docs.sparkSession
    rows = keyed_texts(docs, id_col, text_col)
    if normal is not None:
        rows = rows.withColumn("text", F.coalesce(normal(F.col("text")), F.lit("")))
    local = rows.mapInArrow(_blocks(print_bits, bucket_bits, block_rows, block_bytes), _LOCAL)
    path, name = scratch_path(spark, "dedup-texts"), f"dedup_texts_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local.write.bucketBy(parts, "block").option("path", path).saveAsTable(name)
    try:
        local = spark.table(name)
        sent = local.where("messages is not null").select("block", F.explode("messages").alias("m"))
        sent = sent.select("m.bucket", "block", "m.n", "m.k", "m.bits")
        answers = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _answer, "block long, bucket int, bitmap binary"
        )
        answers = stage(answers, "dedup-bitmaps")
        suspects = local.join(answers, ["block", "bucket"]).where(_bit("bitmap", "nth"))
        # Verification: equal bytes are one group. Map tasks put their own copies together first.
        best = F.struct("keep", (-F.col("block")).alias("earlier"))
        groups = suspects.groupBy("text").agg(
            F.first("sha").alias("sha"), F.max(best).alias("best"), F.sum("copies").alias("size")
        )
        clash = F.raise_error(F.lit("different texts have the same SHA-256")).cast("long")
        labels = groups.groupBy("sha").agg(
            F.max("best").alias("best"), F.when(F.count("*") > 1, clash).otherwise(F.max("size")).alias("size")
        )
        labels = stage(labels.select("sha", "best.keep", "best.earlier", "size"), "dedup-labels")
        labels = labels.select("sha", F.col("keep").alias("all_keep"), F.col("earlier").alias("all_earlier"), "size")
        mine = local.select("block", "sha", "copies", "keep", "members")
        mine = mine.join(sized(labels, _LABEL_BYTES), "sha", "left")
        # Within a block the row that stays is the last one in order of the ids.
        ordered = F.array_sort("members")
        everywhere = F.col("size").isNotNull()
        stays = ~everywhere | (F.col("all_earlier") == -F.col("block"))
        out = mine.select(
            "sha", "copies", "size", "keep", "all_keep", everywhere.alias("shared"), stays.alias("stays"),
            F.size("members").alias("many"), F.posexplode(ordered).alias("at", "m"),
        ).select(
            "m.doc_id", "m.key",
            F.when(F.col("shared"), F.col("all_keep")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("size", "copies").alias("group_size"),
            (F.col("stays") & (F.col("at") == F.col("many") - 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
        return stage(out, "exact-duplicates")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, path)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are; of rows with equal id and text one stays."""
    found = exact_duplicates(docs, id_col, text_col, **settings)
    repeated = stage(found.groupBy("doc_id", "key").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).where("n > 1"), "repeated")
    once = within(docs, repeated.where("kept").select("doc_id", "key"), id_col, text_col)
    gone = found.where(~F.col("kept")).select("doc_id", "key").unionByName(repeated.select("doc_id", "key"))
    return without(docs, gone, id_col, text_col).unionByName(once.dropDuplicates([id_col, text_col]))
