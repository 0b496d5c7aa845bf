"""Language identification by fusing evidence (Bayes).

Four kinds of evidence about the language of a text are added as logarithms:

* the text: byte trigrams under a model of each language, counted over all texts that declare one,
  by an aggregation per (language, trigram bucket); an unknown language has the flat model;
* the declared language (a column, or the ``lang`` attribute of the markup): how often each
  declaration goes with each language, counted over all rows;
* the suffix of the address, counted in the same way;
* the host: shares of the languages among the host's other rows, smoothed towards the shares of its
  parent domain, those towards the shares of all rows. Grouped aggregations give the counts, never a
  list of rows; the row itself is left out of its host's count.

Trigrams of one text are not independent, so the text counts like ``TEXT_WEIGHT`` trigrams at most.
A text is rejected if the flat model wins or the best language has less than ``MIN_POSTERIOR``.

Defined results: null and empty texts, and texts of fewer than ``MIN_LETTERS`` letters, are rejected,
with the language that the other evidence favours. A missing or unknown declaration, suffix or host adds nothing.
Equal rows have equal results. Ties go to the language first in the list. Empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.llm.common import col, groups_of, utf8, without
from planact.session import stage

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BITS = 15
TEXT_WEIGHT = 40.0
MIN_POSTERIOR = 0.5
MIN_LETTERS = 3
HOST_STRENGTH = 10.0
DECLARED_SMOOTHING = 1.0
_CHUNK = 1 << 19

# Letters and bytes of letters beyond ASCII as they are, folded; everything else is one gap.
_FOLD = np.full(256, 32, np.uint8)
for _b in [*range(97, 123), *range(128, 256)]:
    _FOLD[_b] = _b
for _b in range(65, 91):
    _FOLD[_b] = _b + 32


def _trigrams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """For groups of texts: (first, last, text of each trigram, bucket of each trigram).

    Trigrams of gaps only are left out, and those that reach from one text into the next.
    """
    for first, last in groups_of(offsets, _CHUNK):
        lo, hi = int(offsets[first]), int(offsets[last])
        for a in range(lo, max(hi, lo + 1), 4 * _CHUNK):  # a long text in parts
            b = min(hi, a + 4 * _CHUNK)
            raw = _FOLD[data[a : min(hi, b + 2)]].astype(np.uint32)
            if len(raw) < 3:
                yield first, last, np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
            at = np.arange(a, a + len(code))
            text = np.repeat(np.arange(first, last), np.diff(np.clip(offsets[first : last + 1], a, a + len(code))))
            ok = (code != 0x202020) & (at + 2 < offsets[text + 1])
            bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
            yield first, last, text[ok], bucket[ok].astype(np.int64)


def _counts(languages: tuple[str, ...], bits: int):
    """Sums per task before the shuffle: (language number, bucket, count)."""

    def run(batches):
        total = np.zeros((len(languages), 1 << bits), np.int64)
        number = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            which = np.array([number.get(x, -1) for x in batch.column(1).to_pylist()])
            data, offsets = utf8(batch.column(0))
            for _, _, text, bucket in _trigrams(data, offsets, bits):
                spoken = which[text]
                known = spoken >= 0
                flat = np.bincount((spoken[known] << bits) | bucket[known], minlength=total.size)
                total += flat.reshape(total.shape)
        language, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[language, bucket])],
            names=["language", "bucket", "n"],
        )

    return run


def text_model(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, bits: int = BITS) -> np.ndarray:
    """log P(bucket | language), the flat model last: len(languages) + 1 rows of 2**bits, whatever the corpus."""
    found = (
        rows.select("text", "declared")
        .mapInArrow(_counts(languages, bits), "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.full((len(languages) + 1, 1 << bits), 0.5)
    counts[found["language"].to_numpy(), found["bucket"].to_numpy()] += found["n"].to_numpy()
    counts[-1] = 1.0
    return np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def _text_scores(model, languages: tuple[str, ...], bits: int):
    def run(batches):
        table = np.ascontiguousarray(model.value.T)  # bucket -> one value per language
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            n = batch.num_rows
            sums, seen = np.zeros((n, table.shape[1])), np.zeros(n)
            for _, _, text, bucket in _trigrams(data, offsets, bits):
                if len(text):
                    begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                    sums[text[begin]] += np.add.reduceat(table[bucket], begin, axis=0)
                    seen[text[begin]] += np.diff(np.append(begin, len(text)))
            weight = np.minimum(seen, TEXT_WEIGHT) / np.maximum(seen, 1)
            scores = sums * weight[:, None]
            letter = np.concatenate(([0], np.cumsum((_FOLD[data] != 32) & ((data & 0xC0) != 0x80))))
            letters = letter[offsets[1:]] - letter[offsets[:-1]]
            best = np.argmax(scores[:, :-1], 1)
            told = letters >= MIN_LETTERS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    batch.column(4),
                    batch.column(5),
                    pa.array(scores.tolist(), pa.list_(pa.float64())),
                    pa.array([languages[b] if t else None for b, t in zip(best, told)], pa.string()),
                    pa.array(told & (scores[:, :-1].max(1) > scores[:, -1])),
                ],
                names=["doc_id", "key", "declared", "suffix", "host", "scores", "text_language", "readable"],
            )

    return run


def primary(tag: Column) -> Column:
    """The language of a tag: "de-AT" and "de_at" are "de"."""
    return F.lower(F.regexp_extract(F.trim(tag), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))


def markup_language(html: Column) -> Column:
    """The ``lang`` attribute of the html element; empty if it has none."""
    return F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3}(?:[-_][A-Za-z0-9]+)*)""", 1)


def markup_text(html: Column) -> Column:
    """The text of a page without scripts, styles, comments and tags."""
    plain = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(plain, r"&[A-Za-z]+;|&#\w+;", " ")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"\.([a-z]{2,})$", 1)


def parent_of(host: Column) -> Column:
    """The last two labels of a host name; a name without a point is its own parent."""
    return F.regexp_extract(host, r"([^.]+(?:\.[^.]+)?)$", 1)


def evidence_rows(
    df: DataFrame, id_col: str, text: Column, declared: Column | None = None, host: Column | None = None
) -> DataFrame:
    """(doc_id, key, text, declared, suffix, host), null where there is no such evidence."""

    def kept(c: Column | None) -> Column:
        return F.lit(None).cast("string") if c is None else F.nullif(c, F.lit(""))

    host = kept(host)
    return df.select(
        col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(col(id_col), F.coalesce(text, F.lit(""))).alias("key"),
        F.coalesce(text, F.lit("")).alias("text"),
        kept(primary(declared) if declared is not None else None).alias("declared"),
        F.nullif(suffix_of(host), F.lit("")).alias("suffix"),
        host.alias("host"),
    )


def _shares(rows: DataFrame, by: list[str], languages: tuple[str, ...]) -> DataFrame:
    """Counts of the languages per group as one array; partial counts come before the shuffle."""
    counts = [F.count_if(F.col("text_language") == x).cast("double") for x in languages]
    return rows.where(F.col("readable")).groupBy(*by).agg(F.array(*counts).alias("n"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def identify(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, bits: int = BITS) -> DataFrame:
    """(doc_id, key, language, confidence, text_language, declared, host, accepted) for each of ``evidence_rows``."""
    k = len(languages)
    model = rows.sparkSession.sparkContext.broadcast(text_model(rows, languages, bits))
    seen = rows.select("doc_id", "key", "text", "declared", "suffix", "host").mapInArrow(
        _text_scores(model, languages, bits),
        "doc_id long, key long, declared string, suffix string, host string, scores array<double>, "
        "text_language string, readable boolean",
    )
    seen = stage(seen.withColumn("parent", parent_of(F.col("host"))), "text-scores")

    # How each declaration and each suffix goes with the languages: log P(value | language).
    (overall,) = _shares(seen, [], languages).collect()  # one number per language
    everything = F.array(*[F.lit(n + 1.0) for n in overall["n"]])

    def likelihood(column: str) -> DataFrame:
        per_value = _shares(seen.where(F.col(column).isNotNull()), [column], languages)
        scaled = F.zip_with("n", everything, lambda n, total: F.log((n + DECLARED_SMOOTHING) / (total + DECLARED_SMOOTHING)))
        return per_value.select(F.col(column), scaled.alias(f"{column}_log"))

    # Shares of all rows, of the parent domain smoothed towards them, of the host towards its parent.
    parents = _shares(seen.where("host is not null"), ["parent"], languages).withColumnRenamed("n", "parent_n")
    hosts = _shares(seen.where("host is not null"), ["host"], languages).withColumnRenamed("n", "host_n")
    joined = (
        seen.join(stage(likelihood("declared"), "declared"), "declared", "left")
        .join(stage(likelihood("suffix"), "suffix"), "suffix", "left")
        .join(stage(parents, "parents"), "parent", "left")
        .join(stage(hosts, "hosts"), "host", "left")
    )
    none = F.array(*[F.lit(0.0)] * k)
    own = F.array(*[F.when(F.col("readable") & (F.col("text_language") == x), 1.0).otherwise(0.0) for x in languages])

    def towards(counts: Column, base: Column) -> Column:
        others = F.zip_with(F.coalesce(counts, none), own, lambda n, mine: F.greatest(n - mine, F.lit(0.0)))
        total = _sum(others) + HOST_STRENGTH
        return F.zip_with(others, base, lambda n, p: (n + p * HOST_STRENGTH) / total)

    joined = joined.withColumn("prior", F.transform(everything, lambda x: x / (_sum(everything))))
    joined = joined.withColumn("prior", towards(F.col("parent_n"), F.col("prior")))
    joined = joined.withColumn("prior", towards(F.col("host_n"), F.col("prior")))
    total = F.zip_with(F.slice("scores", 1, k), F.col("prior"), lambda s, p: s + F.log(p))
    for c in ("declared_log", "suffix_log"):
        total = F.zip_with(total, F.coalesce(c, none), lambda s, x: s + x)
    joined = joined.withColumn("total", total).withColumn("top", F.array_max("total"))
    weight = _sum(F.transform("total", lambda x: F.exp(x - F.col("top"))))
    best = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("total", F.col("top")).cast("int"))
    joined = joined.withColumn("confidence", 1 / weight)
    return joined.select(
        "doc_id",
        "key",
        F.when(F.col("readable"), best).otherwise(F.lit(UNKNOWN)).alias("language"),
        "confidence",
        "text_language",
        "declared",
        "host",
        (F.col("readable") & (F.col("confidence") >= MIN_POSTERIOR)).alias("accepted"),
    )


def identify_documents(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Documents: the text, the declared ``lang`` and the ``source`` as host."""
    declared = col("lang") if "lang" in docs.columns else None
    host = F.lower(col("source")) if "source" in docs.columns else None
    return identify(evidence_rows(docs, "doc_id", col("text"), declared, host), languages)


def identify_pages(pages: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Pages: the text between the tags, the markup's ``lang``, suffix and host of the address."""
    host = host_of(col("url"))
    return identify(evidence_rows(pages, "page_id", markup_text(col("html")), markup_language(col("html")), host), languages)


def accepted(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """The rows of ``docs`` that are not rejected; all columns as they are."""
    return without(docs, identify_documents(docs, languages).where(~F.col("accepted")).select("doc_id", "key"))
