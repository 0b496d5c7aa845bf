"""Filters of stored movement keys: they save reads and change no result."""

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from planact import schemas
from planact.operators import keyfilter
from planact.sinks import tables as sink
from planact.sources import movements


def batch(spark, *keys):
    """Cleaned movements of (document, day)."""
    data = [tuple({"BpzIdt": d, "BucDat": x, "MngD": "1"}.get(c) for c in schemas.MOVEMENT_FEED_COLUMNS) for d, x in keys]
    raw = spark.createDataFrame(data, ", ".join(f"`{c}` STRING" for c in schemas.MOVEMENT_FEED_COLUMNS))
    return movements.clean_movements(raw)


def stored(spark, path):
    return rows(spark.read.parquet(path), "BpzIdt", "BucDat")


FIRST = [(f"d{i}", f"2025-0{1 + i % 3}-1{i % 10}") for i in range(300)]
SECOND = FIRST[::2] + [(f"e{i}", f"2025-0{1 + i % 4}-1{i % 10}") for i in range(200)] + [(" d1 ", "2025-02-11"), ("d1", "2025-02-12")]
BOTH = sorted([(d, day(x)) for d, x in FIRST + SECOND[150:350] + SECOND[351:]], key=repr)


@pytest.mark.parametrize("tiny", [False, True])
def test_the_store_is_that_of_an_exact_check(spark, tmp_path, monkeypatch, tiny):
    """With one block a month nearly every key is met by chance; the stored keys settle it."""
    if tiny:
        monkeypatch.setattr(keyfilter, "blocks_for", lambda n: 1)
        monkeypatch.setattr(keyfilter, "FULL", 10**9)
    path = str(tmp_path / "t")
    assert sink.append_movements_counted(spark, batch(spark, *FIRST), path) == (300, 0)
    added, looked_up = sink.append_movements_counted(spark, batch(spark, *SECOND), path)
    assert added == 201 and (looked_up > 165 if tiny else 151 <= looked_up <= 160)
    assert sink.append_movements(spark, batch(spark, *SECOND), path) == 0
    assert stored(spark, path) == BOTH


def test_new_documents_read_no_stored_key(spark, tmp_path):
    path = tmp_path / "t"
    sink.append_movements(spark, batch(spark, *FIRST), str(path))
    files = {f: f.read_bytes() for f in path.rglob("part-*.parquet")}
    for f in files:
        f.write_bytes(b"unreadable")
    fresh = [(f"n{i}", "2025-01-15") for i in range(50)]
    assert sink.append_movements_counted(spark, batch(spark, *fresh), str(path)) == (50, 0)
    with pytest.raises(Exception):
        sink.append_movements(spark, batch(spark, FIRST[0]), str(path))
    for f, content in files.items():
        f.write_bytes(content)
    assert spark.read.parquet(str(path)).count() == 350


def test_a_table_without_filters_gets_them(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_by_month(batch(spark, *FIRST), "BucDat", path)
    assert sink.append_movements(spark, batch(spark, *SECOND), path) == 201
    assert stored(spark, path) == BOTH
    held = spark.read.parquet(path + "_keys").groupBy("part_month").agg(F.sum("keys").alias("n"))
    assert {r["part_month"]: r["n"] for r in held.collect()}[day("2025-01-01")] == spark.read.parquet(path).where("part_month = '2025-01-01'").count()


def test_an_interrupted_append_is_made_up_for(spark, tmp_path, monkeypatch):
    """The filter took the rows in and the table did not: they are looked up, found missing and stored."""
    path = str(tmp_path / "t")
    sink.append_movements(spark, batch(spark, *FIRST), path)
    append = sink.append_by_month
    monkeypatch.setattr(sink, "append_by_month", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sink.append_movements(spark, batch(spark, *SECOND), path)
    monkeypatch.setattr(sink, "append_by_month", append)
    assert sink.append_movements_counted(spark, batch(spark, *SECOND), path) == (201, 302)  # April is not stored
    assert stored(spark, path) == BOTH


def test_a_filter_that_fills_up_is_built_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in range(4):
        sink.append_movements(spark, batch(spark, *[(f"{part}-{i}", "2025-01-05") for i in range(40 * 3**part)]), path)
    held = spark.read.parquet(path + "_keys").agg(F.sum("keys"), F.max("blocks"), F.min("blocks")).first()
    assert held[0] == 40 * 40 and held[1] == held[2] and held[0] <= keyfilter.FULL * held[1]
    assert sink.append_movements_counted(spark, batch(spark, ("0-1", "2025-01-05"), ("0-1", "2025-01-06")), path)[0] == 1
