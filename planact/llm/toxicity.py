"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of rows of one hashed table: its own row and those of its beginnings
(``PREFIXES`` bytes). Filters of the widths ``WIDTHS`` slide over a whole text, each keeps its largest
value, and a logistic layer reads those. The classifier is trained on a bounded sample of labelled
rows: the ``PER_CLASS`` rows of each label with the smallest hash of their id (a parameter). Part of
them is held back to set the threshold, over all languages and for each one; a score is shifted so that 0.5 is
the threshold over all. Language only chooses the threshold of ``flagged``; a score sees nothing but words.

Defined results: null and empty texts, and texts without letters, have the score of a text without
words. A row is scored whatever its length; filters see windows that reach over the text's ends as
padded with zeros. Equal rows have equal scores. A document with several labels counts as toxic if one says so. Without
labels of both kinds training raises; an empty table of documents gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.llm.common import col, utf8
from planact.llm.wordhash import words

PER_CLASS = 1500
VALIDATION_SHARE = 0.25
BUCKETS = 1 << 15
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 6)
EPOCHS = 8
RATE = 0.02
BATCH = 32
DROPOUT = 0.3
_SCORED_AT_ONCE = 1 << 16

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def hashed_words(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, prefixes: tuple[int, ...] = PREFIXES):
    """For groups of texts: (first text, last text, text of each word, table rows of each word)."""
    for w in words(data, offsets, _NOT_WORD, prefix_bytes=prefixes):
        features = [w.hash, *w.prefixes]
        salted = [(f + np.uint64(i)) % np.uint64(buckets) for i, f in enumerate(features)]
        yield w.first, w.last, w.text, np.stack(salted, 1).astype(np.int32)


@dataclass
class Model:
    table: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def new(seed: int, buckets: int = BUCKETS) -> Model:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.1, (buckets, DIMENSIONS)).astype(np.float32)
        filters = {w: rng.normal(0, 0.3, (w * DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS}
        bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        return Model(table, filters, bias, rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32))

    def _maps(self, embedded: np.ndarray, width: int) -> np.ndarray:
        """Filter responses of each window of ``width`` words that begins at each word."""
        response = np.broadcast_to(self.bias[width], (len(embedded), FILTERS)).copy()
        for k in range(width):
            part = embedded[k:] @ self.filters[width][k * DIMENSIONS : (k + 1) * DIMENSIONS]
            response[: len(part)] += part
        return response

    def embed(self, ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            out = out + self.table[ids[:, k]]
        return out

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over a text, at least 0, and the word where it stands."""
        best, where = np.zeros(FILTERS * len(WIDTHS), np.float32), np.full(FILTERS * len(WIDTHS), -1)
        if not len(ids):
            return best, where
        for at in range(0, len(ids), _SCORED_AT_ONCE):
            embedded = self.embed(ids[at : at + _SCORED_AT_ONCE + max(WIDTHS) - 1])
            for n, width in enumerate(WIDTHS):
                maps = self._maps(embedded, width)[:_SCORED_AT_ONCE]
                top = maps.argmax(0)
                value = maps[top, np.arange(FILTERS)]
                span = slice(n * FILTERS, (n + 1) * FILTERS)
                better = value > best[span]
                best[span][better] = value[better]
                where[span][better] = top[better] + at
        return best, where

    def logits(self, text: np.ndarray, ids: np.ndarray, first: int, last: int) -> np.ndarray:
        """Of the texts first .. last-1, whose words are sorted by text."""
        n = last - first
        if len(ids) > 2 * _SCORED_AT_ONCE or n == 1:
            pooled = np.stack([self.pooled(ids[text == t])[0] for t in range(first, last)])
            return pooled @ self.out + self.out_bias
        pooled = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
        if len(ids):
            embedded = self.embed(ids)
            begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            rows = text[begin] - first
            for k, width in enumerate(WIDTHS):
                maps = np.broadcast_to(self.bias[width], (len(ids), FILTERS)).copy()
                for j in range(width):
                    m = len(ids) - j
                    if m > 0:
                        part = embedded[j:] @ self.filters[width][j * DIMENSIONS : (j + 1) * DIMENSIONS]
                        part[text[j:] != text[:m]] = 0  # beyond the end of the text
                        maps[:m] += part
                span = slice(k * FILTERS, (k + 1) * FILTERS)
                pooled[rows, span] = np.maximum(np.maximum.reduceat(maps, begin, axis=0), 0)
        return pooled @ self.out + self.out_bias


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def apply(self, key, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        m, v = self.state.setdefault(key, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.999 * v[at] + 0.001 * grad * grad
        fit = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        value[at] -= fit * m[at] / (np.sqrt(v[at]) + 1e-8)


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Train on the table rows of each text's words."""
    model, rng, adam = Model.new(seed), np.random.default_rng(seed), _Adam(rate)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            adam.step += 1
            grads = {w: np.zeros_like(model.filters[w]) for w in WIDTHS}
            biases = {w: np.zeros_like(model.bias[w]) for w in WIDTHS}
            out_grad, out_bias, rows, row_grads = np.zeros_like(model.out), 0.0, [], []
            for i in chosen:
                ids = texts[i]
                best, where = model.pooled(ids)
                keep = (rng.random(len(best)) >= DROPOUT) / (1 - DROPOUT)
                z = float((best * keep) @ model.out + model.out_bias)
                d = weight[i] * (1 / (1 + np.exp(-z)) - labels[i]) / len(chosen)
                out_grad += d * best * keep
                out_bias += d
                back = d * model.out * keep * (where >= 0)
                for f in np.flatnonzero(back):
                    width, g = WIDTHS[f // FILTERS], back[f]
                    biases[width][f % FILTERS] += g
                    span = ids[where[f] : where[f] + width]
                    vectors = model.embed(span)
                    grads[width][: vectors.size, f % FILTERS] += g * vectors.ravel()
                    to_words = g * model.filters[width][: vectors.size, f % FILTERS].reshape(len(span), DIMENSIONS)
                    for k in range(span.shape[1]):
                        rows.append(span[:, k])
                        row_grads.append(to_words)
            for w in WIDTHS:
                adam.apply(("filter", w), model.filters[w], grads[w])
                adam.apply(("bias", w), model.bias[w], biases[w])
            adam.apply("out", model.out, out_grad)
            model.out_bias -= rate * float(out_bias)
            if rows:
                unique, inverse = np.unique(np.concatenate(rows), return_inverse=True)
                summed = np.zeros((len(unique), DIMENSIONS), np.float32)
                np.add.at(summed, inverse, np.concatenate(row_grads))
                adam.apply("table", model.table, summed, unique)
    return model


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the cuts with the largest balanced accuracy; 0 if one label is missing."""
    if labels.min() == labels.max():
        return 0.0
    order = np.argsort(logits)
    z, y = logits[order], labels[order]
    below = np.concatenate(([0], np.cumsum(1 - y))) / max(1, (1 - y).sum())
    above = 1 - np.concatenate(([0], np.cumsum(y))) / max(1, y.sum())
    quality = below + above
    quality[1:-1][z[1:] == z[:-1]] = -1
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    edges = np.concatenate(([z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]))
    return float(edges[best].mean())


def training_rows(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", lang_col: str | None = "lang", held_out: Column | None = None,
) -> DataFrame:
    """(text, label, lang, order): the bounded sample; at most ``per_class`` rows of each label."""
    known = labels.where(col(label_col).isNotNull()).groupBy(col(id_col).cast("long").alias("id")).agg(
        F.max(col(label_col)).cast("int").alias("label")
    )
    if held_out is not None:
        known = known.where(~held_out)
    order = F.xxhash64("id")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(order, "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    lang = F.lit("") if lang_col is None or lang_col not in docs.columns else F.coalesce(col(lang_col), F.lit(""))
    texts = docs.select(
        col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"), lang.alias("lang")
    ).where("id is not null")
    # At most 2 * per_class ids: a size known beforehand, whatever the tables hold.
    joined = texts.join(F.broadcast(chosen), "id")
    one = joined.groupBy("id", "label").agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text", "lang")).alias("t"))
    return one.select("id", "label", "t.text", "t.lang", order.alias("order"))


def _encode(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        found: list[bytes] = []
        for first, last, text, ids in hashed_words(data, offsets):
            at = np.searchsorted(text, np.arange(first, last + 1))
            found += [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(3), batch.column(4), pa.array(found, pa.binary())],
            names=["label", "lang", "order", "words"],
        )


def train(docs: DataFrame, labels: DataFrame, seed: int = 7, **columns) -> Model:
    """Fit and calibrate on the sample; at most 2 * ``per_class`` rows reach the driver, as hashed words."""
    sample = training_rows(docs, labels, **columns).select("id", "label", "text", "lang", "order")
    rows = sample.mapInArrow(_encode, "label int, lang string, order long, words binary").toArrow().sort_by("order")
    y = rows["label"].to_numpy()
    if len(y) == 0 or y.min() == y.max():
        raise ValueError("training needs labels of both kinds")
    texts = [np.frombuffer(x, np.int32).reshape(-1, 1 + len(PREFIXES)) for x in rows["words"].to_pylist()]
    langs = np.array(rows["lang"].to_pylist())
    check = np.arange(len(y)) % round(1 / VALIDATION_SHARE) == 0
    if len(set(y[check])) < 2 or len(set(y[~check])) < 2:
        check[:] = False
    model = fit([t for t, c in zip(texts, check) if not c], y[~check].astype(np.float32), seed)
    part = np.flatnonzero(check if check.any() else ~check)
    logits = np.array([model.pooled(texts[i])[0] @ model.out + model.out_bias for i in part])
    model.shift = _threshold(logits, y[part])
    for lang in sorted(set(langs[part])):
        mine = langs[part] == lang
        if len(set(y[part][mine])) == 2:
            model.thresholds[lang] = float(1 / (1 + np.exp(model.shift - _threshold(logits[mine], y[part][mine]))))
    return model


def scored(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang"
) -> DataFrame:
    """(doc_id, score, threshold, flagged): one row per row; ``flagged`` by the threshold of its language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def run(batches):
        model = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            out = np.empty(batch.num_rows)
            for first, last, text, ids in hashed_words(data, offsets):
                out[first:last] = model.logits(text, ids, first, last)
            score = 1 / (1 + np.exp(np.clip(model.shift - out, -700, 700)))
            cut = np.array([model.thresholds.get(x, 0.5) for x in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(cut), pa.array(score >= cut)],
                names=["doc_id", "score", "threshold", "flagged"],
            )

    lang = F.lit("") if lang_col is None or lang_col not in docs.columns else F.coalesce(col(lang_col), F.lit(""))
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"), lang.alias("lang")
    )
    return rows.mapInArrow(run, "doc_id long, score double, threshold double, flagged boolean")
