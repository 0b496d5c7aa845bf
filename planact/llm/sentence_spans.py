"""Substring dedup by sliding sentence spans.

Every text is cut into sentences. From each sentence on, the shortest run of at least
``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words is hashed. Equal runs are found by one
aggregation over all texts; the first one, by (doc_id, place), stays, and every sentence that any
other one covers is removed.

A sentence ends behind a word with a final stop, exclamation or question mark that no lower-case
letter follows, at the end of a line, or at the end of the text. Sentences of more than
``LONG_SENTENCE`` words are cut behind the smallest word hash of every ``LONG_SENTENCE`` words in a row
(winnowing), so no piece is longer. A passage is cut alike wherever it stands, but for at most
``LONG_SENTENCE`` words at either end that other text joins; between them its cuts agree. So a repeated passage of
more than 50 words always has a run, as 21 words or more are left in between. Case (A-Z and Latin-1 letters) and white space do not count.

Defined results: null and empty texts, and texts of fewer sentences or words, have no runs. Equal
rows (same id and text) count as one document. Of documents that tie, the smaller doc_id is first,
null before all. Tables without repeats, and empty ones, give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts, utf8
from planact.llm.wordhash import mix, powers, prefix, words
from planact.session import stage

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG_SENTENCE = 15
_AT_ONCE = 1 << 16

_RUNS = "doc_id long, key long, h1 long, h2 long, start int, end int"
_SECOND_BASE = 0xD1342543DE82EF95


def _sentence_ends(data: np.ndarray, w, n_bytes: int) -> np.ndarray:
    """For each word, whether a sentence ends behind it."""
    n = len(w.start)
    follows = np.zeros(n, np.int64)
    follows[:-1] = w.start[1:]
    last_of_text = np.ones(n, bool)
    last_of_text[:-1] = w.text[1:] != w.text[:-1]
    follows[last_of_text] = w.end[last_of_text]
    final = np.isin(data[w.end - 1], np.frombuffer(b".!?", np.uint8))
    head = data[np.minimum(follows, n_bytes - 1)]
    second = data[np.minimum(follows + 1, n_bytes - 1)]
    lower = ((head >= 97) & (head <= 122)) | ((head == 0xC3) & (second >= 0x9F) & (second <= 0xBF))
    low = int(w.start[0])
    lines = np.zeros(int(w.end[-1]) - low + 1, np.int32)
    np.cumsum(data[low : int(w.end[-1])] == 10, out=lines[1:])
    new_line = lines[follows - low] > lines[w.end - low]
    return last_of_text | new_line | (final & ~lower)


def _long_cuts(w, ends: np.ndarray) -> np.ndarray:
    """``ends``, and in long sentences behind the last smallest hash of every ``LONG_SENTENCE`` words in a row."""
    n = len(ends)
    if n < LONG_SENTENCE:
        return ends
    sentence = np.zeros(n, np.int64)
    sentence[1:] = np.cumsum(ends)[:-1]
    long = np.bincount(sentence)[sentence] > LONG_SENTENCE
    whole = np.flatnonzero(long[: n - LONG_SENTENCE + 1] & (sentence[: n - LONG_SENTENCE + 1] == sentence[LONG_SENTENCE - 1 :]))
    windows = np.lib.stride_tricks.sliding_window_view(w.hash, LONG_SENTENCE)[:, ::-1]
    cuts = ends.copy()
    for at in range(0, len(whole), _AT_ONCE):
        part = whole[at : at + _AT_ONCE]
        cuts[part + LONG_SENTENCE - 1 - windows[part].argmin(1)] = True
    return cuts


def runs_of(data: np.ndarray, offsets: np.ndarray):
    """(text, h1, h2, start, end) of all runs of a batch; places in bytes of the batch."""
    for w in words(data, offsets):
        if not len(w.start):
            continue
        ends = _long_cuts(w, _sentence_ends(data, w, len(data)))
        stop = np.flatnonzero(ends) + 1  # in words
        begin = np.concatenate(([0], stop[:-1]))
        text = w.text[begin]
        until = np.maximum(np.searchsorted(stop, begin + MIN_WORDS), np.arange(len(stop)) + MIN_SENTENCES - 1)
        ok = until < len(stop)
        ok[ok] = text[until[ok]] == text[ok]
        if not ok.any():
            continue
        a, b = begin[ok], stop[until[ok]]
        hashes = []
        for base in (None, _SECOND_BASE):
            args = () if base is None else (base,)
            sums = prefix(w.hash, *args)
            hashes.append(mix((sums[b] - sums[a]) * powers(len(sums), *args)[1][a] + (b - a).astype(np.uint64)))
        yield text[ok], hashes[0].view(np.int64), hashes[1].view(np.int64), w.start[a], w.end[b - 1]


def _runs(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        for text, h1, h2, start, end in runs_of(data, offsets):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(text)),
                    batch.column(1).take(pa.array(text)),
                    pa.array(h1),
                    pa.array(h2),
                    pa.array((start - offsets[text]).astype(np.int32)),
                    pa.array((end - offsets[text]).astype(np.int32)),
                ],
                names=["doc_id", "key", "h1", "h2", "start", "end"],
            )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, start, end, first_doc_id): every non-first repeated run, in bytes of the text.

    One aggregation finds the hashes that occur more than once and where each occurs first; its
    partial step reduces a passage that many texts share before the shuffle. The runs are then
    joined with those hashes alone, a join whose hot side adaptive execution can split.
    """
    runs = keyed_texts(docs, id_col, text_col).mapInArrow(_runs, _RUNS)
    first = (
        runs.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "start")).alias("first"))
        .where("n > 1")
        .select("h1", "h2", "first")
    )
    first = stage(first, "repeated-runs")
    return (
        runs.join(first, ["h1", "h2"])
        .where(~F.struct("doc_id", "key", "start").eqNullSafe(F.col("first")))
        .select("doc_id", "key", "start", "end", F.col("first.doc_id").alias("first_doc_id"))
    )


def _cut(frames):
    for frame in frames:
        out = []
        for doc_id, text, spans in zip(frame["doc_id"], frame["text"], frame["spans"]):
            raw = text.encode()
            kept, removed, at = [], [], 0
            for start, end in sorted((int(s["start"]), int(s["end"])) for s in spans):
                if removed and start <= removed[-1][1]:
                    removed[-1][1] = max(removed[-1][1], end)
                else:
                    removed.append([start, end])
            for start, end in removed:
                kept.append(raw[at:start])
                at = end
            kept.append(raw[at:])
            places, chars, byte = [], 0, 0
            for start, end in removed:
                chars += len(raw[byte:start].decode())
                size = len(raw[start:end].decode())
                places.append({"start": chars, "end": chars + size})
                chars, byte = chars + size, end
            sources = sorted({int(s["first_doc_id"]) for s in spans if not pd.isna(s["first_doc_id"])})
            out.append((doc_id, places, sum(p["end"] - p["start"] for p in places), sources, b"".join(kept).decode()))
        yield pd.DataFrame(
            {
                "doc_id": pd.array([x[0] for x in out], "Int64"),
                "removed": [x[1] for x in out],
                "removed_chars": [x[2] for x in out],
                "first_doc_ids": [x[3] for x in out],
                "text": [x[4] for x in out],
            }
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that lose something: what was removed (code points), where it stands first, and the rest.

    (doc_id, removed array<struct<start, end>>, removed_chars, first_doc_ids, text). A document that
    is not listed stays as it is.
    """
    spans = (
        repeated_spans(docs, id_col, text_col)
        .groupBy(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"))
        .agg(F.collect_set(F.struct("start", "end", "first_doc_id")).alias("spans"))
    )
    hit = keyed_texts(docs, id_col, text_col).join(
        stage(spans, "spans"), F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key"))
    )
    return hit.select("doc_id", "text", "spans").mapInPandas(
        _cut,
        "doc_id long, removed array<struct<start: int, end: int>>, removed_chars long, "
        "first_doc_ids array<long>, text string",
    )
