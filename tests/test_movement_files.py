"""Movement files: batch, blocks of lines and stream read what Python's csv module reads."""

import csv
import io
import random

import pytest
from conftest import rows

from pyspark.sql import functions as F

from planact import schemas
from planact.catalog import feed_queries
from planact.functions.cleaning import clean_header
from planact.plans import feed_loads
from planact.sources import movements, records
from planact.streaming import ingest

COLUMNS = schemas.MOVEMENT_FEED_COLUMNS
ODD_CELLS = [
    "", "", "plain", "two words", "a, b", 'say "hi"', "line one\nline two", "one\r\n\r\ntwo", '"', '""', "\n", ",\n,", "'q'",
    " blank ", "ü\nß", "1,5", "x" * 300,
]


def written(path, seed, bom=False, end="\n", quote_all=False):
    """A file of random cells under a permuted header; returns what the csv module reads of the expected columns."""
    draw = random.Random(seed)
    names = list(COLUMNS)
    draw.shuffle(names)
    names = names[: draw.randint(20, 39)] + ["Unnamed: 7", "extra"]
    names += [c for c in ("BpzIdt", "BucDat") if c not in names]
    draw.shuffle(names)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
    writer.writerow([f"'{n} '" if draw.random() < 0.2 else n for n in names])
    for i in range(25):
        cells = [draw.choice(ODD_CELLS) for _ in names]
        cells[names.index("BpzIdt")] = f"{path.name}-{i}"
        writer.writerow(cells)
        if draw.random() < 0.1:
            out.write(end)
    text = ("﻿" if bom else "") + out.getvalue()
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(text.encode())
    read = [r for r in csv.reader(io.StringIO(text.lstrip("﻿"), newline="")) if r]
    at = {clean_header(n): i for i, n in reversed(list(enumerate(read[0])))}
    return [tuple(r[at[c]] or None if c in at else None for c in COLUMNS) for r in read[1:]]


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    kinds = [{}, {"bom": True}, {"end": "\r\n"}, {"bom": True, "end": "\r\n", "quote_all": True}, {"quote_all": True}]
    expected = [r for i, kind in enumerate(kinds) for r in written(folder / f"file {i}+%.csv", i, **kind)]
    (folder / "empty.csv").write_text("")
    return str(folder), sorted(expected, key=repr)


def test_files_are_read_as_the_csv_module_reads_them(spark, landed):
    folder, expected = landed
    got = movements.read_movement_files(spark, folder)
    assert rows(got, *COLUMNS) == expected
    assert {r[0] for r in got.select("source_file").distinct().collect()} == {f"file {i}+%.csv" for i in range(5)}


@pytest.mark.parametrize("block", [1500, 1 << 27])
def test_blocks_of_lines(spark, landed, block):
    """Blocks that begin and end inside quoted cells, several blocks inside one record."""
    folder, expected = landed
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = movements.read_movement_files(spark, folder, split_bytes=0)
        assert rows(got, *COLUMNS) == expected
        assert {r[0] for r in got.select("source_file").distinct().collect()} == {f"file {i}+%.csv" for i in range(5)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stray_quote_makes_a_file_be_read_whole(spark, tmp_path):
    text = 'BpzIdt,BucDat,KeziBez\nd1,2025-01-01,5" pipe\nd2,2025-01-02,"two\nlines"\nd3,2025-01-03,6" pipe\n'
    (tmp_path / "a.csv").write_text(text)
    for split in (0, 1 << 20):
        got = movements.read_movement_files(spark, str(tmp_path), split_bytes=split)
        assert rows(got, "BpzIdt", "KeziBez") == [("d1", '5" pipe'), ("d2", "two\nlines"), ("d3", '6" pipe')]


def test_stream_and_batch_store_the_same(spark, landed, tmp_path):
    folder, expected = landed
    load = feed_loads.load_movements(spark, folder, str(tmp_path / "batch"))
    assert load.rows == len(expected)
    files = ingest.stream_movement_files(spark, folder, files_per_batch=2)
    ingest.append_new_movements(files, str(tmp_path / "stream"), str(tmp_path / "c")).awaitTermination()
    ingest.land_movements(files, str(tmp_path / "landed"), str(tmp_path / "c2")).awaitTermination()
    ingest.append_stream(ingest.stream_landed(spark, str(tmp_path / "landed")), "BucDat", str(tmp_path / "all"), str(tmp_path / "c3")).awaitTermination()
    batch = rows(spark.read.parquet(str(tmp_path / "batch")), *COLUMNS)
    assert batch == rows(spark.read.parquet(str(tmp_path / "stream")), *COLUMNS)
    assert batch == rows(spark.read.parquet(str(tmp_path / "all")), *COLUMNS)
    assert load.stored == len(batch)


def test_no_python_reads_records(spark, landed):
    """Neither form has a Python worker in its plan."""
    folder, _ = landed
    for split in (0, 1 << 20):
        plan = movements.read_movement_files(spark, folder, split_bytes=split)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_a_landed_batch_is_not_landed_twice(spark, landed, tmp_path):
    folder, expected = landed
    out = str(tmp_path / "landed")
    files = ingest.stream_movement_files(spark, folder)
    ingest.land_movements(files, out, str(tmp_path / "c")).awaitTermination()
    ingest.land_movements(files, out, str(tmp_path / "lost")).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).parquet(out).count() == len(expected)


def test_missing_columns_raise_or_are_counted(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("BpzIdt,BucDat,MngDD\nd1,2025-01-01,5\n")
    load = feed_loads.load_movements(spark, str(folder), str(tmp_path / "t"))
    assert load.missing_columns["MngD"] == ["a.csv"] and "BpzIdt" not in load.missing_columns
    (folder / "b.csv").write_text("BpzIdt,BuchDat,MngD\nd1,2025-01-01,5\n")
    with pytest.raises(ValueError, match="b.csv has no column BucDat"):
        feed_loads.load_movements(spark, str(folder), str(tmp_path / "t"))


def test_landed_files_grow_in_number(spark, tmp_path):
    """Files of a bounded number of records, each led by its header, hold the rows that one file per kind holds."""
    lines = [(f"{i}-{i % 7}", f"M{i}", 'M "two\nlines", one' if i % 5 == 0 else None, "2025-01-01", "1,5") for i in range(90)]
    given = spark.createDataFrame(lines, "BpzIdt string, MatIdt string, KeziBez string, BucDat string, Zn string").repartition(6)
    raw = given.select(*[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS], F.lit("x").alias("Unnamed: 39"))
    one = feed_queries.write_movement_files(raw, str(tmp_path / "one"))
    many = feed_queries.write_movement_files(raw, str(tmp_path / "many"), rows_per_file=10, few_files=1)
    assert {k: len(list((tmp_path / "many" / k).glob("part-*"))) for k in ("plain", "quoted", "few")} == {"plain": 3, "quoted": 3, "few": 1}
    expected = [tuple(None if c == "Zn" and int(r["BpzIdt"].split("-")[0]) % 3 == 2 else r[c] for c in COLUMNS) for r in raw.collect()]
    for folder in (one, many):
        for split in (0, 1 << 20):
            files = movements.open_movement_files(spark, f"{folder}/{feed_queries.KINDS}", feed_queries.FILES, split)
            assert rows(files.rows, *COLUMNS) == sorted(expected, key=repr)
            assert {c: len(f) for c, f in files.missing.items()} == {"ChgNmr": 1, "Zn": 1}


def test_headers_far_from_the_start(spark, tmp_path):
    for i, lines in enumerate((0, 5, records.NEAR + 5)):
        (tmp_path / f"{i}.csv").write_text("note\n" * lines + f"BpzIdt,BucDat\nd{i},2025-01-01\nBpzIdt,MngD\n")
    (tmp_path / "empty.csv").write_text("")
    found = records.files_with_headers(spark, str(tmp_path), "*.csv", ["BpzIdt", "BucDat"])
    assert [(f.name, f.head) for f in found] == [(f"{i}.csv", "BpzIdt,BucDat") for i in range(3)]
    (tmp_path / "none.csv").write_text("note\n" * 3)
    with pytest.raises(ValueError, match="none.csv"):
        records.files_with_headers(spark, str(tmp_path), "*.csv", ["BpzIdt", "BucDat"])


def test_a_record_is_parsed_once(spark, landed):
    """Conditions on cells stay above the parser."""
    folder, _ = landed
    text = movements.read_movement_files(spark, folder, split_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_csv") == text.count("Generate ") == 5


def test_masses_out_of_range_are_bad_cells(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    cells = ["inf", "-inf", "nan", "1e300", "1000000000", "1000000000,1", "-7,5", ""]
    (folder / "a.csv").write_text("BpzIdt,BucDat,MngD\n" + "".join(f'd{i},2025-01-0{i + 1},"{c}"\n' for i, c in enumerate(cells)))
    load = feed_loads.load_movements(spark, str(folder), str(tmp_path / "t"))
    assert load.bad_cells == {"MngD": 5}
    got = rows(spark.read.parquet(str(tmp_path / "t")), "BpzIdt", "MngD")
    assert [v for _, v in got] == [0.0, 0.0, 0.0, 0.0, 1e9, 0.0, -7.5, 0.0]
