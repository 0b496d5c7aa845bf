"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.session import stage

#: Most that a broadcast table may take in memory.
BROADCAST_BYTES = 32 << 20
_KEY_BYTES = 100  # a row of two LONG keys in a hash table, with room to spare


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def text_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Tells rows with the same id but different texts apart."""
    return F.xxhash64(col(id_col), F.coalesce(col(text_col), F.lit("")))


def keyed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, text): ids as LONG, null texts as empty ones; equal rows have equal keys."""
    return df.select(
        col(id_col).cast("long").alias("doc_id"),
        text_key(id_col, text_col).alias("key"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    )


def sized(df: DataFrame, row_bytes: int, extra_bytes: int = 0) -> DataFrame:
    """``df``, a written table, to be broadcast if counting shows that it is small enough.

    Its rows are counted (on Parquet, from the footers). Up to ``BROADCAST_BYTES`` the other side of a
    join stays where it is; beyond, the join shuffles both. The result is the same.
    """
    return F.broadcast(df) if df.count() * row_bytes + extra_bytes <= BROADCAST_BYTES else df


def _matched(df: DataFrame, marked: DataFrame, how: str, id_col: str, text_col: str) -> DataFrame:
    names = fresh(df, "_m_id"), fresh(df, "_m_key")
    marked = marked.select(F.col("doc_id").alias(names[0]), F.col("key").alias(names[1])).distinct()
    marked = sized(stage(marked, "marked"), _KEY_BYTES)
    same = marked[names[0]].eqNullSafe(df[f"`{id_col}`"].cast("long")) & (
        marked[names[1]] == F.xxhash64(df[f"`{id_col}`"], F.coalesce(df[f"`{text_col}`"], F.lit("")))
    )
    return df.join(marked, same, how)


def without(df: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` whose (doc_id, key) is not in ``marked``; all columns stay as they are.

    ``marked`` is written first, so that its size is known: see ``sized``.
    """
    return _matched(df, marked, "left_anti", id_col, text_col)


def within(df: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` whose (doc_id, key) is in ``marked``; see ``without``."""
    return _matched(df, marked, "left_semi", id_col, text_col)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each value begins (one more at the end)."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def groups_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive values whose bytes together stay below ``most``; a longer value stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)
