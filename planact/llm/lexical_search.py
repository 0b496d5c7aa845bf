"""Ranked lexical search, half term at a time and half document at a time.

``forward`` reads every text once and keeps, per document, its length and the counts of the terms that the
queries name. ``search`` turns the rows a task reads into shards of bounded size: posting lists sorted by
document, with the exact integer contribution of every posting. In a shard each query is answered by

* term at a time: the lists of up to ``SHORT`` of the shard's documents are summed into accumulators, one sorted list of
  documents with partial scores, which from then on is an iterator like any other, bounded by its largest sum;
* document at a time: the iterators are ordered by their bounds. As long as those with the smallest bounds
  cannot lift a document above the tenth best score so far, they name no candidates: candidates come from the others,
  in document order, and the small ones are skipped along, looked up only for candidates that what is left could
  still lift. Documents are taken in windows that double in size, so that numpy does the work and the
  threshold rises early.

Nothing but ten rows per query and shard is shuffled, and of these every task hands on its best ten. Scores are 64-bit
integers, bounds are exact, so the result is that of scoring every document.

The queries are dealt into blocks of at most ``VOCABULARY_BYTES`` of text, each a pass over the documents, so the
vocabulary that goes to the tasks is bounded whatever the number of queries.

Defined results: null and empty texts and texts of separators alone hold no term; they count nowhere and are never
found. Queries without a term, or whose terms no document holds, give no rows. Equal scores rank by doc_id, null last,
then by the text's key; repeated rows are documents of their own. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts
from planact.session import stage

TOP = 10
SHORT = 1 / 32
SHARD_POSTINGS = 2_000_000
FIRST_WINDOW = 256
VOCABULARY_BYTES = 8 << 20

# Separators become blanks and A-Z small letters; bytes of other characters stay as they are.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_FORWARD = "doc_id long, key long, n long, terms array<int>, tfs array<int>"
_FOUND = "item_id long, item_key long, score long, doc_id long, key long"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _count(numbers: dict[bytes, int]):
    def run(batches):
        for batch in batches:
            length, terms, tfs = [], [], []
            for text in batch.column(2).to_pylist():
                words = terms_of(text)
                met = [(numbers[w], c) for w, c in Counter(words).items() if w in numbers]
                length.append(len(words))
                terms.append([t for t, _ in met])
                tfs.append([c for _, c in met])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(length, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "key", "n", "terms", "tfs"],
            )

    return run


def forward(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, n, terms, tfs): every document's length and its counts of the numbered terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # at most VOCABULARY_BYTES of query text

    def run(batches):
        return _count(shared.value)(batches)

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, _FORWARD)


class Shard:
    """Posting lists of some documents: per term the documents, ascending, and their contributions."""

    def __init__(
        self, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, corpus: tuple[int, int]
    ):
        docs, total = corpus
        m = 10 + (90 * lengths * docs) // total
        order = np.lexsort((doc, term))
        doc, term, tf = doc[order], term[order], tf[order]
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some, begin = np.unique(term, return_index=True)
        end = np.append(begin[1:], len(term))
        self.size = len(lengths)
        self.lists = {t: (doc[a:b], value[a:b]) for t, a, b in zip(some.tolist(), begin.tolist(), end.tolist())}


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of some lists with the sum of their contributions, as one list."""
    docs, where = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, where, np.concatenate([v for _, v in lists]))
    return docs, sums


def _looked_up(docs: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The contributions of a list to ``wanted`` documents, skipping what lies between them."""
    at = np.searchsorted(docs, wanted)
    at[at == len(docs)] = 0
    return np.where(docs[at] == wanted, values[at], 0)


def best_of(shard: Shard, terms: list[int], top: int = TOP, short: float = SHORT) -> list[tuple[int, int]]:
    """(score, document) of the best documents of a shard, best first, ties by document; scores above 0."""
    lists = [shard.lists[t] for t in terms if t in shard.lists]
    small = [x for x in lists if len(x[0]) <= short * shard.size]
    long = [x for x in lists if len(x[0]) > short * shard.size]
    iterators = long + ([accumulated(small)] if small else [])
    if not iterators:
        return []
    iterators.sort(key=lambda x: int(x[1].max()))
    below = np.concatenate(([0], np.cumsum([int(x[1].max()) for x in iterators])))  # all bounds before each
    best: list[tuple[int, int]] = []  # (-score, document), sorted
    least = 0  # a later document must beat this
    at, window = 0, FIRST_WINDOW
    while at < shard.size:
        end = min(shard.size, at + window)
        # The iterators before ``first`` cannot lift a document above the threshold by themselves.
        first = int(np.searchsorted(below, least, "right")) - 1
        if first >= len(iterators):
            break
        parts = []
        for docs, values in iterators[first:]:
            a, b = np.searchsorted(docs, (at, end))
            parts.append((docs[a:b], values[a:b]))
        score = np.zeros(end - at, np.int64)
        for docs, values in parts:
            score[docs - at] += values  # a list holds a document once
        named = np.flatnonzero(score + below[first] > least)
        wanted, score = named + at, score[named]
        for i in range(first - 1, -1, -1):
            if not len(wanted):
                break
            score = score + _looked_up(*iterators[i], wanted)
            stays = score + below[i] > least
            wanted, score = wanted[stays], score[stays]
        keep = score > least
        if keep.any():
            best = sorted(best + list(zip((-score[keep]).tolist(), wanted[keep].tolist())))[:top]
            if len(best) == top:
                least = -best[-1][0]
        at, window = end, 2 * window
    return [(-s, d) for s, d in best]


def _searched(items: list[tuple], weights: np.ndarray, corpus: tuple[int, int], top: int, short: float, shard_postings: int):
    """Rows of the forward table -> the best rows of every shard and item."""

    def answer(batch: pa.Table):
        doc_id, key = batch["doc_id"].combine_chunks(), batch["key"].combine_chunks()
        # Documents in the order that breaks ties.
        missing = doc_id.is_null().to_numpy(zero_copy_only=False)
        ids = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((key.to_numpy(), ids, missing))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        terms = batch["terms"].combine_chunks()
        many = np.diff(terms.offsets.to_numpy())
        doc = np.repeat(rank, many)
        lengths = batch["n"].to_numpy()[order]
        flat = terms.flatten().to_numpy().astype(np.int64)
        tfs = batch["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
        shard = Shard(lengths, doc, flat, tfs, weights, corpus)
        found = [(i, k, s, d) for i, k, wanted in items for s, d in best_of(shard, wanted, top, short)]
        at = order[np.array([d for *_, d in found], np.int64)] if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, *_ in found], pa.int64()),
                pa.array([k for _, k, *_ in found], pa.int64()),
                pa.array([s for *_, s, _ in found], pa.int64()),
                doc_id.take(pa.array(at)),
                key.take(pa.array(at)),
            ],
            names=["item_id", "item_key", "score", "doc_id", "key"],
        )

    def run(batches):
        held, postings = [], 0
        for batch in batches:
            held.append(batch)
            postings += len(batch.column(3).flatten()) + batch.num_rows
            if postings >= shard_postings:
                yield answer(pa.Table.from_batches(held))
                held, postings = [], 0
        if postings:
            yield answer(pa.Table.from_batches(held))

    return run


def weight(documents: Column, holding: Column) -> Column:
    return F.floor(1000 * F.log((2 * documents + 2).cast("double") / (2 * holding + 1).cast("double"))).cast("long")


def _ranked_block(docs: DataFrame, items: list[tuple], id_col: str, text_col: str, top: int, short: float, shard_postings: int):
    """The best of all shards for one block of items [(item_id, key, text)]."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    asked = [(i, k, sorted({numbers.setdefault(w, len(numbers)) for w in terms_of(t)})) for i, k, t in items]
    index = stage(forward(docs, numbers, id_col, text_col), "forward")
    count = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    corpus = tuple(count.first())
    weighed = holding.select("term", weight(F.lit(corpus[0]), F.col("df")).alias("w"))
    weights = np.zeros(max(1, len(numbers)), np.int64)
    for r in weighed.toLocalIterator():  # at most one row per term of the block
        weights[r.term] = r.w
    shared = spark.sparkContext.broadcast((asked, weights))

    def run(batches):
        items, weights = shared.value
        return _searched(items, weights, corpus, top, short, shard_postings)(batches)

    found = index.where("size(terms) > 0").mapInArrow(run, _FOUND)
    order = [F.col("score").desc(), F.col("doc_id").isNull(), "doc_id", "key"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "item_key").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    short: float = SHORT,
    shard_postings: int = SHARD_POSTINGS,
    vocabulary_bytes: int = VOCABULARY_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every query, best first."""
    items = keyed_texts(queries, item_col, item_text_col)
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("s")).first().s
    blocks = max(1, -(-int(size) // vocabulary_bytes))
    parts = None
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(blocks)) == block)
        part = _ranked_block(docs, [tuple(r) for r in some.toLocalIterator()], id_col, text_col, top, short, shard_postings)
        part = stage(part, "ranked") if blocks > 1 else part
        parts = part if parts is None else parts.unionByName(part)
    return parts.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
