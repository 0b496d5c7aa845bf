"""What loads and reads of movement files leave and hold on disk."""

import re
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_key_filters import BOTH, FIRST, SECOND, batch, stored

from planact import schemas, session
from planact.catalog import feed_queries
from planact.operators import keyfilter
from planact.plans import feed_loads
from planact.session import stage, staging
from planact.sinks import tables as sink
from planact.sources import movements, records
from planact.streaming import ingest

COLUMNS = schemas.MOVEMENT_FEED_COLUMNS


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    """A scratch folder of the test's own, and what is in it."""
    folder = tmp_path / "scratch"
    monkeypatch.setattr(session, "scratch_root", lambda _: str(folder))
    return lambda: {p.name.rsplit("-", 1)[0] for p in folder.glob("*")}


def raw_rows(spark, count):
    lines = [(f"{3 * i}-{i % 7}", 'M "two\nlines", one' if i % 3 == 0 else None, "2025-01-01") for i in range(count)]
    given = spark.createDataFrame(lines, "BpzIdt string, KeziBez string, BucDat string").coalesce(1)
    return given.select(*[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS], F.lit("x").alias("Unnamed: 39"))


def test_lines_of_large_files_move_and_are_stored_once(spark, tmp_path, monkeypatch):
    text = "BpzIdt,BucDat,KeziBez\n" + "".join(f'd{i},2025-01-01,"{"line" * 9}\n{i}\n\nend"\n' if i % 4 else f"d{i},2025-01-02,M\n" for i in range(60))
    (tmp_path / "a.csv").write_text(text)
    staged, keep = [], records.stage

    def seen(df, purpose):
        plan = df._jdf.queryExecution().executedPlan().toString()
        staged.append(("value" in df.columns or "record" in df.columns, len(re.findall(r"Exchange hashpartitioning\(file#\d+, block", plan))))
        return keep(df, purpose)

    monkeypatch.setattr(records, "stage", seen)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        got = movements.read_movement_files(spark, str(tmp_path), split_bytes=0)
        assert rows(got, "BpzIdt", "KeziBez") == sorted((f"d{i}", f"{'line' * 9}\n{i}\n\nend" if i % 4 else "M") for i in range(60))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [exchanges for text, exchanges in staged if text] == [1]
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_a_landed_batch_leaves_nothing_but_its_rows(spark, tmp_path, monkeypatch, scratch):
    folder = feed_queries.write_movement_files(raw_rows(spark, 30), str(tmp_path / "in"))
    read = movements.read_movement_files
    monkeypatch.setattr(movements, "read_movement_files", lambda spark, paths: read(spark, paths, split_bytes=0))
    files = ingest.stream_movement_files(spark, f"{folder}/plain", feed_queries.FILES)
    ingest.land_movements(files, str(tmp_path / "landed"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "landed")).count() == 30
    assert scratch() == set()


def test_files_do_not_grow_with_the_rows_of_a_task(spark, tmp_path, scratch):
    """One task makes several files, each led by its header; the text they were made from is not kept."""
    folder = feed_queries.write_movement_files(raw_rows(spark, 30), str(tmp_path), rows_per_file=10)
    assert scratch() == set()
    files = sorted((tmp_path / "plain").glob("part-*"))
    assert len(files) == 3 and all(f.read_text().startswith("BpzIdt,MatIdt,") for f in files)
    got = movements.read_movement_files(spark, f"{folder}/plain", feed_queries.FILES)
    assert rows(got, *COLUMNS) == rows(raw_rows(spark, 30), *COLUMNS)


def test_a_load_lets_go_of_its_records(spark, tmp_path, monkeypatch, scratch):
    folder = feed_queries.write_movement_files(raw_rows(spark, 9), str(tmp_path / "in"))
    held, append = [], sink.append_movements_counted
    monkeypatch.setattr(sink, "append_movements_counted", lambda *a: held.append(scratch()) or append(*a))
    load = feed_loads.load_movements(spark, f"{folder}/plain", str(tmp_path / "t"), feed_queries.FILES, 0)
    assert load.rows == load.stored == 9
    assert held == [{"movement-rows"}] and scratch() == set()


@pytest.mark.parametrize("at_once", [40, 10**6])
def test_filters_are_asked_by_keys_and_rows_appended_in_parts(spark, tmp_path, monkeypatch, at_once):
    path, asked, appends = str(tmp_path / "t"), [], []
    marked, append = keyfilter.marked, sink.append_by_month
    monkeypatch.setattr(keyfilter, "marked", lambda df, *a: asked.append(len(df.columns)) or marked(df, *a))
    monkeypatch.setattr(sink, "append_by_month", lambda *a: appends.append(append(*a)) or appends[-1])
    monkeypatch.setattr(sink, "ROWS_AT_ONCE", at_once)
    sink.append_movements(spark, batch(spark, *FIRST), path)
    assert sink.append_movements(spark, batch(spark, *SECOND), path) == 201
    assert sink.append_movements(spark, batch(spark, *SECOND), path) == 0
    assert stored(spark, path) == BOTH
    assert asked == [3, 3] and max(appends) < (100 if at_once == 40 else 400)
    assert len(appends) == (8 + 6 + 1 if at_once == 40 else 3)


@pytest.mark.parametrize("more", [0, 40])
def test_rows_without_a_document_are_always_new(spark, tmp_path, more):
    """Whether the stored keys or the new ones are fewer."""
    path, nil = str(tmp_path / "t"), F.nullif("BpzIdt", F.lit("nil"))
    first = [(f"d{i}", "2025-01-05") for i in range(9)] + [("d1", "2025-01-05"), ("nil", "2025-01-05")]
    second = first + [(f"n{i}", "2025-01-05") for i in range(more)] + [("n1", "2025-01-06")] * 2
    for keys, n in ((first, 11), (second, more + 3)):
        assert sink.append_movements(spark, batch(spark, *keys).withColumn("BpzIdt", nil), path) == n
    found = [d for d, _ in stored(spark, path)]
    assert found.count(None) == 2 and found.count("d1") == 2 and found.count("n1") == 2 + (more > 0) and len(found) == 14 + more


def test_shuffle_files_go_with_their_statement(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = held()
    with staging(spark):
        grouped = stage(spark.range(1000).repartition(7).groupBy(F.col("id") % 10).count())
        assert grouped.count() == 10
        for _ in range(100):
            if held() <= before:
                break
            time.sleep(0.1)
        assert held() <= before
