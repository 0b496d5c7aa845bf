"""Near duplicates by SimHash, found through an inverted index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most ``MAX_BITS`` = 3 bits differ in at most 3 of their 8
bytes, so they share at least 5 bytes at the same positions. Lists of single positional bytes
would each hold 1/256 of all fingerprints, so the index lists four positions together: the 14 planes
of the 8 points of {0,1}^3. Three positions always lie in one plane, and the opposite plane is then free of
differences; hence any two fingerprints that share 5 positional bytes meet in at least one list, and
random ones meet with a chance of 14 / 2^32. Inside a list the shared positional bytes of each pair are tallied,
pairs below 5 are dropped (count filtering) and the bits of the rest are verified.

A list hands on only links that join parts not joined yet, so a large group of near copies gives as
many links as members and not their square. A list longer than ``BLOCK`` is compared in pairs of
blocks, each a task's share of bounded size. Components follow from the links.

Defined results: null and empty texts and texts of white space have fingerprint zero and are linked
like any other. Equal rows share their component. A null doc_id counts as no id: its row keeps its
component, whose name is the smallest id that is not null (null if there is none). Other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts, within, without
from planact.llm.components import components
from planact.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCK = 2048
_AT_ONCE = 1 << 15

# Byte positions indexed together: the points of each plane a.x = b of {0,1}^3.
PLANES = [
    [x for x in range(8) if bin(x & a).count("1") % 2 == b] for a, b in itertools.product(range(1, 8), range(2))
]


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if over half of the shingle hashes have it set; no words give zero."""
    found = text.encode().lower().split()  # on bytes: folds A-Z only, splits at 0x20 and 0x09-0x0D
    if not found:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(found) - shingle_words + 1)
    for at in range(0, n, _AT_ONCE):
        part = found[at : at + _AT_ONCE + shingle_words - 1]
        if len(part) < shingle_words:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle_words))))
        raw = b"".join(map(_digest, shingles))
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _digest(shingle: bytes) -> bytes:
    return xxhash.xxh64_digest(shingle, SEED)


def _fingerprints(shingle_words: int):
    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "key", "fp"],
            )

    return run


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, key, fp): one row per row; the fingerprint as a signed LONG."""
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        _fingerprints(shingle_words), "doc_id long, key long, fp long"
    )


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filtering, then verification: tally equal bytes, keep the guaranteed number, count bits."""
    tally = (a.view(np.uint8).reshape(-1, 8) == b.view(np.uint8).reshape(-1, 8)).sum(1)
    near = tally >= 8 - max_bits
    near[near] = np.bitwise_count(np.broadcast_to(a, b.shape)[near] ^ b[near]) <= max_bits
    return near


def _spanning(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int):
    """Links between a[i] and b[j] (j > i if ``same``), only those that join parts still apart."""
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(a)):
        j0 = i + 1 if same else 0
        if j0 < len(b):
            for j in np.flatnonzero(_close(a[i : i + 1], b[j0:], max_bits)) + j0:
                x, y = top(int(a[i])), top(int(b[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    yield int(a[i]), int(b[j])


def _links(max_bits: int):
    """Rows sorted by (list, lo, hi) -> links; holds one group, at most two blocks, at a time."""

    def group_links(block, fp):
        if block[0] == block[-1] and (block == block[0]).all():
            fp = np.sort(fp)
            return list(_spanning(fp, fp, True, max_bits))
        low = block == block.min()
        return list(_spanning(fp[low], fp[~low], False, max_bits))

    def solve(columns):
        """All groups of some sorted rows; pairs are compared together, larger groups one by one."""
        key = np.stack(columns[:3], 1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
        lo, hi, block, fp = columns[1], columns[2], columns[3], columns[4].view(np.uint64)
        two = begin[end - begin == 2]
        two = two[(lo[two] == hi[two]) | (block[two] != block[two + 1])]
        near = _close(fp[two], fp[two + 1], max_bits) if len(two) else np.zeros(0, bool)
        found = list(zip(fp[two][near].tolist(), fp[two + 1][near].tolist()))
        for s, e in zip(begin[end - begin > 2], end[end - begin > 2]):
            if lo[s] == hi[s] or block[s:e].min() != block[s:e].max():
                found += group_links(block[s:e], fp[s:e])
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not batch.num_rows:
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
            at = int(last[-1]) + 1 if len(last) else 0
            if at:
                yield solve([x[:at] for x in rows])
            held = [x[at:] for x in rows]
        if held is not None:
            yield solve(held)

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all fingerprints (distinct ``fp``) within ``max_bits`` = 0 .. 3 bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index covers up to 3 differing bits")
    def byte(position):
        return F.shiftright("fp", 8 * position).bitwiseAND(0xFF)

    keys = []
    for number, plane in enumerate(PLANES):
        value = F.lit(number).cast("long")
        for position in plane:
            value = F.shiftleft(value, 8).bitwiseOR(byte(position))
        keys.append(value)
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("list"))
    shared = postings.groupBy("list").count().where("count > 1")
    listed = postings.join(shared, "list")
    # A list of n blocks becomes n(n+1)/2 groups of at most two blocks each.
    blocks = F.ceil(F.col("count") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    listed = listed.select("list", "fp", blocks.alias("blocks"), mine.alias("block"))
    listed = listed.select(
        "list", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("list", "fp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    grouped = listed.repartition("list", "lo", "hi").sortWithinPartitions("list", "lo", "hi")
    return grouped.select("list", "lo", "hi", "block", "fp").mapInArrow(_links(max_bits), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, key, fp, group_fp, component_id): one row per row of ``docs``.

    Rows with one fingerprint are one node, so copies never meet each other. ``group_fp`` is the
    smallest fingerprint of the component, ``component_id`` its smallest doc_id.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = components(near_links(nodes.select("fp"), max_bits))
    named = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group_fp")
    )
    named = stage(named, "node-components")
    names = stage(named.groupBy("group_fp").agg(F.min("least").alias("component_id")), "component-names")
    labels = stage(named.join(names, "group_fp").select("fp", "group_fp", "component_id"), "labels")
    return rows.join(labels, "fp").select("doc_id", "key", "fp", "group_fp", "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: the first of each component.

    First is the smallest doc_id (null last), then the smallest text key; of equal rows one stays.
    """
    found = stage(near_duplicates(docs, id_col, text_col).select("doc_id", "key", "group_fp"), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    first = found.groupBy("group_fp").agg(F.min(order).alias("first"))
    first = stage(first.select("group_fp", F.col("first.doc_id").alias("f_id"), F.col("first.key").alias("f_key")), "firsts")
    is_first = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("key") == F.col("f_key"))
    drop = found.join(first, "group_fp").where(~is_first).select("doc_id", "key")
    repeated = stage(found.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key"), "repeated")
    once = within(docs, repeated.join(first, is_first, "left_semi"), id_col, text_col)
    return without(docs, drop.unionByName(repeated), id_col, text_col).unionByName(
        once.dropDuplicates([id_col, text_col])
    )
