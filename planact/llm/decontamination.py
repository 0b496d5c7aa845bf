"""Benchmark decontamination through templates.

Texts become templates: numbers, units behind numbers, and capitalised words inside a sentence turn
into typed placeholders, all other words are folded. Every window of ``WINDOW`` template words of a
benchmark item is hashed, and so is every window of every document. Windows that meet are joined with
the item's, grouped by the distance between their places, and the slots compared: one benchmark value
must always stand for one document value and the other way round. A document that holds at least
``MIN_SHARE`` of an item's windows in consistent groups is contaminated, also if the item's numbers
and names were exchanged.

Before the join a bitmap of fixed size (``BITMAP_BITS`` bits, whatever the benchmark holds) drops
windows inside the task that reads the text; what passes by chance is dropped by the join.

Defined results: items without a window of ``MIN_WORDS`` plain words (empty and null texts, bare
numbers) match nothing. Items shorter than a window are one window. Equal items are items of their
own, equal documents rows of one document. Null and empty documents hold nothing. Empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import keyed_texts, utf8, without
from planact.llm.wordhash import mix, powers, prefix, span_hash, words
from planact.session import stage

WINDOW = 8
MIN_WORDS = 4
MIN_SHARE = 0.5
BITMAP_BITS = 24

UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml l hl ms s sec min h hr hrs day days week weeks year years "
    "hour hours minute minutes second seconds meter meters metre metres mile miles inch inches feet gram grams "
    "liter liters litre litres percent pct kb mb gb tb hz khz mhz w kw mwh kwh v a usd eur gbp dollar dollars euro "
    "euros cent cents kmh mph c f k"
).split()

_LETTERS = np.ones(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x1F3D5B79, 0x2E4C6A88, 0x3D5B7997))
_WINDOWS = "doc_id long, key long, size int, hash long, place int, slots array<long>"


def _digit(b: np.ndarray) -> np.ndarray:
    return (b >= 48) & (b <= 57)


def _cuts(raw: np.ndarray, inside: np.ndarray):
    """Numbers keep their points and commas and end where letters begin."""
    digit = _digit(raw)
    joint = np.zeros(len(raw), bool)
    joint[1:-1] = np.isin(raw[1:-1], np.frombuffer(b".,", np.uint8)) & digit[:-2] & digit[2:]
    breaks = np.zeros(len(raw), bool)
    breaks[1:] = inside[1:] & inside[:-1] & (digit[1:] != digit[:-1]) & ~joint[1:] & ~joint[:-1]
    return inside | joint, breaks


def _accented_capital(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a two-byte capital of Latin-1 begins there."""
    second = data[np.minimum(at + 1, len(data) - 1)]
    return (data[np.minimum(at, len(data) - 1)] == 0xC3) & (second >= 0x80) & (second <= 0x9E)


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    sums = prefix(data.astype(np.uint64) + np.uint64(1))
    return span_hash(sums, np.array([0]), np.array([len(data)]))[0]


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))


def templates(data: np.ndarray, offsets: np.ndarray):
    """For groups of texts: (text, template hash, is a slot, hash of the word itself) of every word."""
    for w in words(data, offsets, _LETTERS, _cuts):
        n = len(w.start)
        if not n:
            continue
        first, second = data[w.start], data[np.minimum(w.start + 1, len(data) - 1)]
        number = _digit(first)
        same_text = np.zeros(n, bool)
        same_text[1:] = w.text[1:] == w.text[:-1]
        unit = np.isin(w.hash, _UNIT_HASHES)
        unit[1:] &= number[:-1] & same_text[1:]
        unit[0] = False
        unit &= ~number
        # Inside a sentence: behind a word of the same text with no stop or line end between.
        low = int(w.start[0])
        stops = np.zeros(int(w.end[-1]) - low + 1, np.int32)
        np.cumsum(np.isin(data[low : int(w.end[-1])], np.frombuffer(b".!?\n:", np.uint8)), out=stops[1:])
        going_on = same_text.copy()
        going_on[1:] &= stops[w.start[1:] - low] == stops[w.end[:-1] - low]
        # A capital and then a small letter: words in capitals throughout are words like others.
        third = data[np.minimum(w.start + 2, len(data) - 1)]
        plain, accented = (first >= 65) & (first <= 90), _accented_capital(data, w.start)
        after = np.where(accented, third, second)
        follows = w.end - w.start > np.where(accented, 2, 1)
        small = ((after >= 97) & (after <= 122)) | (after == 0xC3) & ~_accented_capital(data, w.start + np.where(accented, 2, 1))
        capital = (plain | accented) & follows & small
        name = capital & going_on & ~unit
        template = w.hash.copy()
        template[number], template[unit], template[name] = _NUMBER, _UNIT, _NAME
        yield w.text, template, number | unit | name, w.hash


def windows_of(data: np.ndarray, offsets: np.ndarray, sizes: list[int], whole: bool = False):
    """(size, text, place, hash, slot flags, words) of windows with enough plain words.

    ``whole``: also the texts shorter than the largest size, as one window each.
    """
    for text, template, slot, word in templates(data, offsets):
        sums = prefix(template)
        slots = np.concatenate(([0], np.cumsum(slot)))
        first = np.searchsorted(text, text)  # where the word's text begins
        size_of = np.searchsorted(text, text, "right") - first
        for size in sizes:
            if size > len(text):
                continue
            a = np.arange(len(text) - size + 1)
            ok = text[a] == text[a + size - 1]
            if whole and size < max(sizes):
                ok &= size_of[a] == size
            ok &= size - (slots[a + size] - slots[a]) >= MIN_WORDS
            a = a[ok]
            value = mix((sums[a + size] - sums[a]) * powers(len(sums))[1][a] + np.uint64(size))
            yield size, text[a], a - first[a], value, a, slot, word


def _emit(sizes: list[int], bitmap: np.ndarray | None, whole: bool, bits: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for size, text, place, value, a, slot, word in windows_of(data, offsets, sizes, whole):
                if bitmap is not None:
                    at = value >> np.uint64(64 - bits)
                    keep = (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    text, place, value, a = text[keep], place[keep], value[keep], a[keep]
                if not len(a):
                    continue
                cover = a[:, None] + np.arange(size)
                flags, values = slot[cover], word[cover].view(np.int64)
                begins = np.concatenate(([0], np.cumsum(flags.sum(1)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text)),
                        batch.column(1).take(pa.array(text)),
                        pa.array(np.full(len(a), size, np.int32)),
                        pa.array(value.view(np.int64)),
                        pa.array(place.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(begins), pa.array(values[flags])),
                    ],
                    names=["doc_id", "key", "size", "hash", "place", "slots"],
                )

    return run


def _bits_of(bits: int):
    def run(batches):
        for batch in batches:
            value = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((value >> np.uint64(3)).astype(np.int32)), pa.array((1 << (value & np.uint64(7))).astype(np.int32))],
                names=["byte", "bit"],
            )

    return run


def _bitmap(items: DataFrame, bits: int) -> np.ndarray:
    """Bytes of the bitmap, or-ed by an aggregation; at most 2**(bits - 3) rows reach the driver."""
    found = (
        items.select("hash").mapInArrow(_bits_of(bits), "byte int, bit int").groupBy("byte").agg(F.bit_or("bit").alias("bit"))
    ).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[found["byte"].to_numpy()] = found["bit"].to_numpy().astype(np.uint8)
    return out


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """(doc_id, key, item_id, windows, item_windows, share, exact): documents that hold an item's template.

    ``exact``: every slot holds the benchmark's own value.
    """
    short = list(range(1, window + 1))
    items = keyed_texts(benchmark, item_col, item_text_col).mapInArrow(_emit(short, None, True, bitmap_bits), _WINDOWS)
    items = items.select(F.col("doc_id").alias("item_id"), F.col("key").alias("item_key"), "size", "hash",
                         F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    items = stage(items, "item-windows")
    total = items.groupBy("item_id", "item_key").agg(F.countDistinct("item_place").alias("item_windows"))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most ``window`` rows
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(items, bitmap_bits))  # 2**bits bits, always

    def emit(batches):
        return _emit(sizes, bitmap.value, False, bitmap_bits)(batches)

    found = keyed_texts(docs, id_col, text_col).mapInArrow(emit, _WINDOWS)
    met = found.join(items, ["size", "hash"]).select(
        "doc_id", "key", "item_id", "item_key", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), "slots", "item_slots"
    )
    where = ["doc_id", "key", "item_id", "item_key", "shift"]
    met = stage(met, "met-windows")
    # Slots: pairs of values that stand at the same place of an aligned copy, each way one to one.
    pairs = met.select(*where, F.explode(F.arrays_zip("item_slots", "slots")).alias("p")).distinct()
    pairs = pairs.select(*where, F.col("p.item_slots").alias("theirs"), F.col("p.slots").alias("ours"))
    sides = [pairs.groupBy(*where, c).agg(F.count("*").alias("n")).where("n > 1").select(*where) for c in ("theirs", "ours")]
    broken = sides[0].unionByName(sides[1]).distinct().withColumn("broken", F.lit(True))
    changed = pairs.where("theirs <> ours").select(*where).distinct().withColumn("changed", F.lit(True))

    def same(a, b):
        on = F.lit(True)
        for c in where:
            on = on & a[c].eqNullSafe(b[c])
        return on

    broken, changed = stage(broken, "broken"), stage(changed, "changed")
    good = met.join(broken, same(met, broken), "left_anti")
    flagged = good.join(changed, same(good, changed), "left").select(
        *[good[c] for c in where], "item_place", F.coalesce("changed", F.lit(False)).alias("changed")
    )
    per_place = flagged.groupBy("doc_id", "key", "item_id", "item_key", "item_place").agg(F.min("changed").alias("changed"))
    per_item = per_place.groupBy("doc_id", "key", "item_id", "item_key").agg(
        F.count("*").alias("windows"), (~F.max("changed")).alias("exact")
    )
    joined = per_item.join(
        total.select(F.col("item_id").alias("t_id"), F.col("item_key").alias("t_key"), "item_windows"),
        F.col("item_id").eqNullSafe(F.col("t_id")) & (F.col("item_key") == F.col("t_key")),
    )
    share = F.col("windows") / F.col("item_windows")
    return joined.withColumn("share", share).where(F.col("share") >= min_share).select(
        "doc_id", "key", "item_id", "windows", "item_windows", "share", "exact"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns as they are."""
    names = {k: v for k, v in columns.items() if k in ("id_col", "text_col")}
    return without(docs, contamination(docs, benchmark, **columns).select("doc_id", "key"), **names)
