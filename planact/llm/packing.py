"""Packing documents into token sequences: best-fit decreasing.

A document's ids are cut into full windows and one remainder. Remainders, largest first, go to the
open window with the least room that still holds them; a segment tree over the remaining capacities
finds it. Packing runs in bins of about ``BIN_PIECES`` remainders each, dealt by a hash, so bins are
independent tasks of bounded size and what a bin leaves open at its end is a few windows in thousands.

Ids come from the byte-level BPE file of ``public_tokenizers``; its ranks give the ids of the
``tokenizers`` library at several times the speed (tests compare the two). The name of the special
token in a text is that token, as there. Every document ends with id 0.

Padding: sequences are padded to ``SEQUENCE`` ids, except where their length is a power of two.

Defined results: null and empty texts give one piece, the closing id. Equal rows are packed once each.
Long texts are encoded in parts cut where the tokenizer's own pattern always ends a word. Empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts
from planact.session import stage

SEQUENCE = 1024
CLOSING_ID = 0
BIN_PIECES = 20_000
PART_CHARS = 1 << 18
TOKENIZER = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}

_ENCODERS: dict = {}
# A new line directly before a letter: the pattern's white-space branch always ends there.
_PART_END = re.compile(r"(?<=[^\W\d_])\n(?=[^\W\d_])")


def encoder(path: str | None = None):
    """The tokenizer, loaded once per Python worker."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
    return _ENCODERS[path]


def encode(text: str, path: str | None = None) -> np.ndarray:
    """The ids of a text, without the closing one."""
    enc, parts, at = encoder(path), [], 0
    while len(text) - at > PART_CHARS:
        cut = _PART_END.search(text, at + PART_CHARS)
        if cut is None:
            break
        parts.append(enc.encode_to_numpy(text[at : cut.start()], allowed_special="all"))
        at = cut.start()
    parts.append(enc.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts).astype("<u4")


def _pieces(sequence: int, path: str | None):
    def run(batches):
        from pyspark import TaskContext

        deal = np.uint64(TaskContext.get().partitionId() << 40)
        seen = 0
        for batch in batches:
            doc, start, length, crc, total, number = [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                ids = np.append(encode(text, path), np.uint32(CLOSING_ID)).astype("<u4")
                for at in range(0, len(ids), sequence):
                    piece = ids[at : at + sequence]
                    doc.append(doc_id)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
                    number.append(seen)
                    seen += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(crc, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array((np.array(number, np.uint64) + deal).view(np.int64)),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"],
            )

    return run


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, path: str | None = None
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, piece): full windows and remainders; ``piece`` is unique."""
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        _pieces(sequence, path),
        "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, piece long",
    )


class OpenWindows:
    """Windows by remaining capacity; a segment tree of counts finds the tightest that fits."""

    def __init__(self, sequence: int):
        self.leaves = 1 << sequence.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, capacity: int, step: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += step
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, window) with the smallest capacity of at least ``least``, or None."""
        count, node = self.count, least + self.leaves
        while not count[node]:
            while node & 1:  # a right child: go up until there is something to the right
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        self._add(capacity, -1)
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each length, for lengths in decreasing order."""
    tree, opened = OpenWindows(sequence), 0
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        found = tree.take(n)
        if found is None:
            room, into = sequence, opened
            opened += 1
        else:
            room, into = found
        window[i], offset[i] = into, sequence - room
        if room > n:
            tree.put(room - n, into)
    return window, offset


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    bin_pieces: int = BIN_PIECES,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: where its ids stand in its document and in which sequence they go.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length). Full windows
    are sequences already and never shuffled. ``sequence_id`` is unique; its upper bits name the bin
    or, if negative, a full window.
    """
    cut = stage(pieces(docs, id_col, text_col, sequence, path), "pieces")
    rest = cut.where(F.col("length") < sequence)
    bins = max(1, -(-rest.count() // bin_pieces))
    dealt = rest.withColumn("bin", F.pmod(F.xxhash64("piece"), F.lit(bins)).cast("int"))
    placed = dealt.groupBy("bin").applyInPandas(
        lambda key, frame: _pack_rows(frame, sequence),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, used long",
    )
    full = cut.where(F.col("length") == sequence).select(
        "doc_id", "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens",
        (-F.col("piece") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(sequence).cast("long").alias("used"),
    )
    exact = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return full.unionByName(placed).withColumn(
        "padded_length", F.when(exact, F.col("used")).otherwise(F.lit(sequence).cast("long"))
    ).drop("used")


def _pack_rows(frame: pd.DataFrame, sequence: int) -> pd.DataFrame:
    frame = frame.sort_values(["length", "piece"], ascending=[False, True]).reset_index(drop=True)
    window, offset = best_fit_decreasing(frame["length"].to_numpy(), sequence)
    used = np.bincount(window, weights=frame["length"].to_numpy()).astype(np.int64)
    return pd.DataFrame(
        {
            "doc_id": frame["doc_id"].astype("Int64"),
            "start": frame["start"],
            "length": frame["length"].astype(np.int64),
            "ids_crc32": frame["ids_crc32"],
            "doc_tokens": frame["doc_tokens"],
            "sequence_id": frame["bin"].astype(np.int64) * (1 << 32) + window,
            "offset": offset,
            "used": used[window],
        }
    )
