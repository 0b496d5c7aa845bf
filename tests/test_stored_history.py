"""Stored reports that are kept up to date by month, and production days with rows that come late."""

import datetime as dt

from conftest import day, rows
from test_streams import drop

from planact import schemas
from planact.operators import telemetry as ops
from planact.plans import stored_history as history
from planact.sinks import tables as sink
from planact.sources import telemetry
from planact.streaming import corrections


def inputs(make, late):
    moved = [("A", f"2025-0{m}-0{d}", "ROH", 55, -1000.0 * d) for m in (1, 2, 3) for d in range(1, 6)]
    moved += [("B", "2025-02-28", "ROH", 53, -777.0), ("B", "2025-02-03", "HIBE", 55, -50.0)]
    if late:
        moved += [("A", "2025-02-02", "ROH", 55, -5000.0), ("B", "2025-02-27", "KRSM", 55, -3000.0)]
    return make.inputs(
        materials=[("A", "first", "Cons", "H"), ("B", "second", "Others", "RI")],
        movements=moved,
        plan=[(v, a, f"2025-0{m}-01", k, 100 * m) for v in ("V0", "V1") for a in ("A", "B") for m in (1, 2, 3) for k in ("budget", "forecast")],
        shutdown=[(v, f"2025-0{m}-05", k, 12) for v in ("V0", "V1") for m in (1, 2, 3) for k in ("budget", "forecast")],
        telemetry=[(f"2025-0{m}-01 0{h}:00:00", 1, 10 * m + h, 1, 2, 3, 4) for m in (1, 2, 3, 4) for h in (5, 6)],
    )


def files(folder, month):
    return {f.name for f in (folder / f"part_month={month}").glob("*.parquet")}


def test_a_late_month_is_made_again_alone(spark, make, tmp_path):
    changes, root = str(tmp_path / "changes"), tmp_path / "root"
    before, after = inputs(make, False), inputs(make, True)
    history.note_changes(before.shutdown, changes)
    assert history.refresh(spark, before, changes, str(root)) == [day("2025-01-01"), day("2025-02-01"), day("2025-03-01")]
    assert history.refresh(spark, before, changes, str(root)) == []
    kept = {(n, m): files(root / n, m) for n in history.REPORTS for m in ("2025-01-01", "2025-03-01")}
    history.note_changes(after.movements.where("day between date'2025-02-01' and date'2025-02-28' and kg < -2500"), changes)
    assert history.refresh(spark, after, changes, str(root)) == [day("2025-02-01")]
    assert kept == {(n, m): files(root / n, m) for n, m in kept}
    full = tmp_path / "full"
    history.note_changes(after.shutdown, changes)
    history.refresh(spark, after, changes, str(full))
    for name in history.REPORTS:
        got = spark.read.parquet(str(root / name))
        assert rows(got) == rows(spark.read.parquet(str(full / name)).select(*got.columns)), name
    whole = history.daily_report.daily_history(after)
    assert rows(spark.read.parquet(str(root / "daily")), *whole.columns) == rows(whole)
    sums = history.category_sums.category_sums_history(after)
    assert rows(spark.read.parquet(str(root / "category_sums")), *sums.columns) == rows(sums)


def test_an_interrupted_refresh_is_done_again(spark, make, tmp_path):
    changes, root = str(tmp_path / "changes"), str(tmp_path / "root")
    data = inputs(make, True)
    history.note_changes(data.shutdown, changes)
    try:
        history.refresh(spark, data, changes, root, {"daily": history.REPORTS["daily"], "sums": lambda *_: 1 / 0})
    except ZeroDivisionError:
        pass
    assert len(history.refresh(spark, data, changes, root, {"daily": history.REPORTS["daily"]})) == 3


def test_only_touched_months_are_read(spark, make, tmp_path):
    data, path, readings = inputs(make, True), str(tmp_path / "t"), str(tmp_path / "r")
    sink.append_by_month(data.movements, "day", path)
    sink.append_by_month(data.telemetry, "ts", readings)
    stored = history.replace(data, movements=spark.read.parquet(path), telemetry=spark.read.parquet(readings))
    cut = history.cut(stored, [day("2025-02-01")])
    assert len(cut.movements.inputFiles()) and all("part_month=2025-02-01" in f for f in _read(cut.movements))
    assert {f.split("part_month=")[1][:7] for f in _read(cut.telemetry)} <= {"2025-02", "2025-03"}
    # The production day of the last of February ends in March, and its first hours are still January's.
    assert rows(cut.telemetry, "ts") == [(dt.datetime(2025, 2, 1, 6),), (dt.datetime(2025, 3, 1, 5),)]


def _read(df):
    return [r[0] for r in df.selectExpr("input_file_name()").distinct().collect()]


def test_a_row_sixty_days_late_changes_its_day(spark, tmp_path):
    landed, args = tmp_path / "in", [str(tmp_path / n) for n in ("table", "days", "late", "checkpoint")]

    def run(checkpoint=args[3]):
        corrections.ingest_and_correct(spark, str(landed), *args[:3], checkpoint).awaitTermination()
        return rows(spark.read.parquet(args[1]), "day", "feed")

    drop(landed, "a.csv", ("2025-01-02 06:00:00", 20), ("2025-01-03 05:00:00", 1))
    drop(landed, "b.csv", ("2025-03-05 07:00:00", 5))
    assert run() == [(day("2025-01-02"), 21.0), (day("2025-03-05"), 5.0)]
    drop(landed, "c.csv", ("2025-01-02 08:00:00", 500), ("2025-03-05 08:00:00", 1), ("2025-02-01 05:00:00", 7))
    corrected = [(day("2025-01-02"), 521.0), (day("2025-01-31"), 7.0), (day("2025-03-05"), 6.0)]
    assert run() == corrected
    assert rows(spark.read.parquet(args[2]), "ts") == [(dt.datetime(2025, 1, 2, 8),), (dt.datetime(2025, 2, 1, 5),)]
    # A lost checkpoint repeats every file: nothing is stored twice, the days stay as they are.
    assert run(str(tmp_path / "lost")) == corrected
    stored = spark.read.parquet(args[0])
    assert rows(ops.by_production_day(stored), "day", "feed") == corrected and stored.count() == 6
    batch = ops.by_production_day(telemetry.parse(telemetry.read_telemetry_files(spark, str(landed))))
    assert rows(batch, "day", "feed") == corrected


def test_corrections_keep_no_state(spark, tmp_path):
    landed = tmp_path / "in"
    drop(landed, "a.csv", ("2025-01-02 06:00:00", 20))
    folder = tmp_path / "c"
    corrections.ingest_and_correct(spark, str(landed), *[str(tmp_path / n) for n in "tdl"], str(folder)).awaitTermination()
    assert not (folder / "state").exists()
    assert schemas.PART_MONTH in spark.read.parquet(str(tmp_path / "d")).columns
