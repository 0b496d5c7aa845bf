import datetime as dt
import time

from conftest import day, rows

from planact import schemas
from planact.sinks.tables import MONTH
from planact.sources import telemetry
from planact.streaming import ingest, progress, windows

COLUMNS = ",".join(schemas.MOVEMENT_FEED_COLUMNS)


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("Plant,,,,,,,\n" + "".join(f"{t},1,{feed},1,2,0,3,4\n" for t, feed in lines))


def test_each_file_once(spark, tmp_path):
    landed, table, ckpt = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    drop(landed, "a.csv", ("2025-01-05 06:00:00", 10), ("2025-01-05 07:00:00", 11))
    for _ in range(2):
        ingest.ingest_telemetry(spark, str(landed), table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    drop(landed, "b.csv", ("2025-02-05 06:00:00", 12))
    ingest.ingest_telemetry(spark, str(landed), table, ckpt).awaitTermination()
    assert rows(spark.read.parquet(table), "feed", MONTH) == [
        (10.0, day("2025-01-01")), (11.0, day("2025-01-01")), (12.0, day("2025-02-01"))
    ]


def movement_lines(*pairs):
    out = [COLUMNS]
    for doc, posted in pairs:
        cells = {"BpzIdt": doc, "MatIdt": "M", "MatArt": "ROH", "BucDat": posted, "LPlzIdt": "55", "MngD": "-1"}
        out.append(",".join(cells.get(c, "") for c in schemas.MOVEMENT_FEED_COLUMNS))
    return "\n".join(out) + "\n"


def test_stored_documents_are_not_added_again(spark, tmp_path):
    landed, table = tmp_path / "in", str(tmp_path / "t")
    landed.mkdir()
    (landed / "a.csv").write_text(movement_lines(("d1", "2025-01-01"), ("d1", "2025-01-02")))
    rows_in = ingest.stream_movement_files(spark, str(landed))
    ingest.append_new_movements(rows_in, table, str(tmp_path / "c")).awaitTermination()
    (landed / "b.csv").write_text(movement_lines(("d1", "2025-01-02"), ("d2", "2025-01-02")))
    ingest.append_new_movements(rows_in, table, str(tmp_path / "c")).awaitTermination()
    # A checkpoint that is lost repeats every file and still adds nothing.
    ingest.append_new_movements(rows_in, table, str(tmp_path / "c2")).awaitTermination()
    assert rows(spark.read.parquet(table), "BpzIdt", "BucDat") == [
        ("d1", day("2025-01-01")), ("d1", day("2025-01-02")), ("d2", day("2025-01-02"))
    ]


def landed_rows(spark, tmp_path, files_per_batch=None):
    files = ingest.stream_movement_files(spark, str(tmp_path / "in"), files_per_batch=files_per_batch)
    ingest.land_movements(files, str(tmp_path / "landed"), str(tmp_path / "c-landed")).awaitTermination()
    return ingest.stream_landed(spark, str(tmp_path / "landed"), files_per_batch)


def test_bounded_dedup(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    (landed / "a.csv").write_text(movement_lines(("d1", "2025-01-01"), ("d1", "2025-01-01"), (" d1", "2025-01-01"), ("d2", "2025-01-01"), ("d3", "?")))
    kept = ingest.distinct_movements(landed_rows(spark, tmp_path))
    ingest.append_stream(kept, "BucDat", str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    # The row without a readable date is kept, not taken for late.
    assert rows(spark.read.parquet(str(tmp_path / "t")).selectExpr("trim(BpzIdt)")) == [("d1",), ("d2",), ("d3",)]


def test_production_days_and_late_rows(spark, tmp_path):
    landed, table, ckpt = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        raw = telemetry.parse(telemetry.stream_telemetry_files(spark, str(landed))).select(*schemas.TELEMETRY.fieldNames())
        days = windows.production_days(raw, lateness="1 day")
        ingest.upsert_stream(days, table, days.schema, ["day"], MONTH, ckpt).awaitTermination()
        return rows(spark.read.schema(days.schema).parquet(table), "day", "feed")

    drop(landed, "a.csv", ("2025-01-02 05:59:00", 10), ("2025-01-02 06:00:00", 20))
    assert run() == [(day("2025-01-01"), 10.0), (day("2025-01-02"), 20.0)]
    # More of a day that is still open, and a day far ahead that moves the watermark.
    drop(landed, "b.csv", ("2025-01-02 07:00:00", 5), ("2025-01-20 08:00:00", 1))
    assert run() == [(day("2025-01-01"), 10.0), (day("2025-01-02"), 25.0), (day("2025-01-20"), 1.0)]
    # Beyond the watermark: dropped, the finished day stays as it is.
    drop(landed, "c.csv", ("2025-01-02 08:00:00", 500), ("2025-01-20 09:00:00", 2))
    assert run() == [(day("2025-01-01"), 10.0), (day("2025-01-02"), 25.0), (day("2025-01-20"), 3.0)]


def test_stream_equals_batch(spark, tmp_path):
    from planact.operators import telemetry as ops

    landed = tmp_path / "in"
    for i in range(4):
        base = dt.datetime(2025, 1, 1 + i)
        drop(landed, f"f{i}.csv", *[((base + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S"), h) for h in range(24)])
    batch = ops.by_production_day(telemetry.parse(telemetry.read_telemetry_files(spark, str(landed))))
    raw = telemetry.parse(telemetry.stream_telemetry_files(spark, str(landed), files_per_batch=1))
    days = windows.production_days(raw.select(*schemas.TELEMETRY.fieldNames()), lateness="30 days")
    ingest.upsert_stream(days, str(tmp_path / "t"), days.schema, ["day"], MONTH, str(tmp_path / "c")).awaitTermination()
    stored = spark.read.schema(days.schema).parquet(str(tmp_path / "t"))
    assert rows(stored, *ops.SUMMED, "day") == rows(batch, *ops.SUMMED, "day")


def test_no_unseen_document_is_late(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    for i, posted in enumerate(("2025-03-01", "2025-03-02", "2025-01-05", "2025-03-01")):
        (landed / f"{i}.csv").write_text(movement_lines((f"d{i % 3}", posted)))
    kept = ingest.distinct_movements(landed_rows(spark, tmp_path, files_per_batch=1))
    ingest.append_stream(kept, "BucDat", str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "BpzIdt", "BucDat") == [
        ("d0", day("2025-03-01")), ("d1", day("2025-03-02")), ("d2", day("2025-01-05"))
    ]


def test_batch_and_stream_share_one_table(spark, tmp_path):
    from planact.plans import feed_loads

    landed, table = tmp_path / "in", str(tmp_path / "t")
    drop(landed, "a.csv", ("2025-01-05 06:00:00", 10))
    feed_loads.load_telemetry(spark, str(landed), table, str(tmp_path / "ledger"))
    drop(landed, "b.csv", ("2025-01-06 06:00:00", 11))
    for checkpoint in ("c", "c", "lost"):
        ingest.ingest_telemetry(spark, str(landed), table, str(tmp_path / checkpoint)).awaitTermination()
    assert rows(spark.read.parquet(table), "feed") == [(10.0,), (11.0,)]


def test_streams_tell_what_they_saw(spark, tmp_path):
    landed, counts, loads = tmp_path / "in", progress.ObservedCounts(), []
    drop(landed, "a.csv", ("2025-01-05 06:00:00", 10), ("2025-01-05 07:00:00", "x"))
    drop(landed, "b.csv", ("2025-01-06 06:00:00", ""), ("someday", 1))
    spark.streams.addListener(counts)
    try:
        ingest.ingest_telemetry(spark, str(landed), str(tmp_path / "t"), str(tmp_path / "c"), files_per_batch=1).awaitTermination()
        for _ in range(100):
            if counts.counts["telemetry"]["rows"] == 6:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    seen = {k: n for k, n in counts.counts["telemetry"].items() if n}
    assert seen == {"rows": 6, "without_time": 3, "feed": 1}
    moved = tmp_path / "moved"
    moved.mkdir()
    (moved / "a.csv").write_text(movement_lines(("d1", "2025-01-01"), ("d2", "?")))
    (moved / "b.csv").write_text(movement_lines(("d1", "2025-01-01")))
    for checkpoint in ("m1", "m2"):
        files = ingest.stream_movement_files(spark, str(moved))
        ingest.append_new_movements(files, str(tmp_path / "m"), str(tmp_path / checkpoint), told=loads.append).awaitTermination()
    assert [(x.rows, x.stored, x.bad_cells) for x in loads] == [(3, 3, {"BucDat": 1}), (3, 0, {"BucDat": 1})]
