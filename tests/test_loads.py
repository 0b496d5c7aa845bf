import datetime as dt

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from planact import schemas
from planact.operators import calendar as cal
from planact.operators import change, dedupe, quality, upsert
from planact.plans import feed_loads, plan_load
from planact.sinks import tables as sink
from planact.sources import grids, ledger, movements
from planact.sources.tables import exists, read_or_empty

BUDGET = """name,id,dummy,cat,2025-01-01 00:00:00,2025-02-01 00:00:00,Sum,2019-01-01 00:00:00
Alpha,1110203,x,H,10.5,,99,7
Beta,1210203,x,P,20,30,99,7
Beta two,1210203-b,x,P,1,2,99,7
Wrong,2110203,x,H,5,5,5,5
"""
FORECAST = """name,id,dummy,cat,Jan.25,01.02.2025
{version},,,,,
Alpha,1110203,x,H,11,12
Beta,1210203,x,P,21,31
"""
YEARS = range(2023, 2029)
HELP = """Plan,,,,
date,a,b,c,shutdown h
10.01.2025,x,x,x,24
11.01.2025,x,x,x,oops
total,x,x,x,24
10.01.2031,x,x,x,24
"""


def sheets(folder, version="V1", budget=BUDGET, down=HELP):
    base = folder / version
    base.mkdir(exist_ok=True)
    texts = {"budget": budget, "forecast": FORECAST.format(version=version), "budget_shutdown": down, "forecast_shutdown": HELP}
    for name, text in texts.items():
        (base / f"{name}.csv").write_text(text)
    return {name: str(base / f"{name}.csv") for name in texts}


def test_sheet_scan(spark, tmp_path):
    book = grids.read_workbook(spark, **sheets(tmp_path), years=YEARS)
    assert rows(book["materials"]) == [
        ("1110203", "Alpha", "Cons", "H"), ("1210203", "Beta", "Paste", "P"), ("1210203-b", "Beta two", "Paste", "P")
    ]
    got = rows(book["budget"])
    assert ("V1", "1110203", day("2025-01-01"), "budget", 10.5) in got
    assert ("V1", "1110203", day("2025-02-01"), "budget", None) in got
    assert len(got) == 6 and len(rows(book["forecast"])) == 4
    assert rows(book["budget_shutdown"]) == [
        ("V1", day("2025-01-10"), "budget", 24.0), ("V1", day("2025-01-11"), "budget", 0.0)
    ]


def test_workbook_load(spark, tmp_path):
    store = plan_load.PlanStore(str(tmp_path / "store"))
    first = plan_load.load_workbook(spark, sheets(tmp_path), store, YEARS)
    assert first.flags.first()["store_empty"] and first.should_load()
    facts = spark.read.schema(schemas.PLAN_FACT).parquet(store.plan)
    assert facts.count() == 10
    assert rows(facts.where("month = '2025-02-01' and material_id = '1110203'"), "measure", "value") == [
        ("budget", 0.0), ("forecast", 12.0)
    ]
    # The same version again is refused, also with changed numbers.
    again = plan_load.load_workbook(spark, sheets(tmp_path, budget=BUDGET.replace("10.5", "11.5")), store, YEARS)
    assert again.flags.first()["version_in_use"] and not again.should_load()
    assert spark.read.parquet(store.plan).count() == 10
    # A new version with one changed cell is loaded next to the old one.
    third = plan_load.load_workbook(spark, sheets(tmp_path, "V2", budget=BUDGET.replace("10.5", "11.5")), store, YEARS)
    flags = third.flags.first().asDict()
    assert flags["should_load"] and flags["changed_budget_cells"] == 1 and flags["new_materials"] == 0
    assert flags["changed_versions"] == 5 and flags["changed_forecast_cells"] == 0 and flags["changed_shutdown_days"] == 0
    assert spark.read.parquet(store.plan).count() == 20
    members = rows(spark.read.schema(schemas.TIME_MEMBER).parquet(store.time))
    assert members == [(2025, 1, 1, 0, True), (2025, 1, 1, 10, False), (2025, 1, 1, 11, False), (2025, 1, 2, 0, True)]
    assert rows(change.versions(spark.read.parquet(store.plan))) == [("V1",), ("V2",)]


def test_missing_category_stops_the_load(spark, tmp_path):
    with pytest.raises(quality.QualityError) as e:
        plan_load.load_workbook(spark, sheets(tmp_path, budget=BUDGET.replace(",P,20", ", ,20")), plan_load.PlanStore(str(tmp_path / "s")))
    assert rows(e.value.bad_rows, "material_id") == [("1210203",)]
    assert not exists(spark, str(tmp_path / "s" / "dim_material"))


def test_change_checks(make):
    stored = make.plan(("V1", "A", "2025-01-01", "budget", 100), ("V1", "B", "2025-01-01", "budget", 5)).unionByName(
        make.plan(("V2", "A", "2025-01-01", "budget", 101), ("V2", "A", "2025-02-01", "budget", None), stamp="2024-02-01")
    )
    assert rows(change.latest_values(stored)) == [
        ("A", day("2025-01-01"), "budget", 101.0), ("B", day("2025-01-01"), "budget", 5.0)
    ]
    assert rows(change.latest_versions(stored)) == [("A", "budget", "V2"), ("B", "budget", "V1")]
    new = make.plan(("V2", "A", "2025-01-01", "budget", "101.0005"), ("V2", "B", "2025-01-01", "budget", 6), ("V2", "C", "2025-01-01", "budget", 0))
    assert rows(change.changed_cells(new, stored)) == [("B", day("2025-01-01"), "budget", 5.0, 6.0)]
    assert rows(change.changed_versions(new, stored), "material_id") == [("B",), ("C",)]
    assert rows(change.new_materials(new, stored)) == [("C",)]
    down = make.shutdown(("V1", "2025-01-10", "budget", 24))
    assert rows(change.changed_shutdown(make.shutdown(("V2", "2025-01-10", "budget", 24)), down)) == []
    assert len(rows(change.changed_shutdown(make.shutdown(("V2", "2025-01-10", "budget", 20), ("V2", "2025-01-11", "budget", 0)), down))) == 2


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    source = spark.createDataFrame([("b", 3), ("c", 4)], "k STRING, v INT")
    assert rows(upsert.upsert(target, source, ["k"])) == [("a", 1), ("b", 3), ("c", 4)]
    twice = spark.createDataFrame([("b", 3, 0), ("b", 5, 1)], "k STRING, v INT, o INT")
    last = dedupe.last_row_wins(twice, ["k"], "o").drop("o")
    assert rows(upsert.upsert(target, last, ["k"])) == [("a", 1), ("b", 5)]
    nulls = spark.createDataFrame([("a", None)], "k STRING, v INT")
    assert rows(upsert.upsert(target, nulls, ["k"])) == [("a", None), ("b", 2)]
    assert rows(upsert.insert_if_absent(target, source, ["k"])) == [("c", 4)]


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k STRING, v INT, p STRING"
    one = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ddl)
    sink.upsert_partitions(spark, path, one.schema, one, ["k"], "p")
    before = {f.name for f in (tmp_path / "t" / "p=x").glob("*.parquet")}
    sink.upsert_partitions(spark, path, one.schema, spark.createDataFrame([("b", 9, "y"), ("c", 3, "z")], ddl), ["k"], "p")
    assert rows(spark.read.schema(one.schema).parquet(path)) == [("a", 1, "x"), ("b", 9, "y"), ("c", 3, "z")]
    assert {f.name for f in (tmp_path / "t" / "p=x").glob("*.parquet")} == before


def test_movements_already_stored(make, spark):
    def docs(*pairs):
        return spark.createDataFrame([(d, "M", "L", day(x), "ROH", 55, 1.0) for d, x in pairs], schemas.MOVEMENT)

    stored = docs(("d1 ", "2025-01-01"))
    new = docs(("d1", "2025-01-01"), ("d1", "2025-01-02"), ("d2", "2025-01-01"), ("d2", "2025-01-01"))
    assert rows(dedupe.new_movements(new, stored), "doc_id", "day") == [
        ("d1", day("2025-01-02")), ("d2", day("2025-01-01")), ("d2", day("2025-01-01"))
    ]


HEADER = "'BpzIdt',MatIdt,MatArt,LPlzIdt,BucDat,'MngD ',Unnamed: 7\n"


def test_movement_folder(spark, tmp_path):
    landed, table = tmp_path / "landed", str(tmp_path / "table")
    landed.mkdir()
    (landed / "a.csv").write_text(HEADER + 'd1,M1,ROH,55,2025-01-05,"-1234,5",x\nd2,M1,ROH,abc,bad,n/a,x\n')
    (landed / "notes.txt").write_text("not a feed")
    feed_loads.load_movements(spark, str(landed), table)
    feed_loads.load_movements(spark, str(landed), table)
    core = rows(movements.movement_core(spark.read.parquet(table)), *schemas.MOVEMENT.fieldNames())
    assert core == [("d1", "M1", " ", day("2025-01-05"), "ROH", 55, -1234.5), ("d2", "M1", " ", day("1970-01-01"), "ROH", -1, 0.0)]
    (landed / "b.csv").write_text(HEADER + "d1,M1,ROH,55,2025-01-06,-1,x\nd1,M1,ROH,55,2025-01-05,-1,x\n")
    feed_loads.load_movements(spark, str(landed), table)
    assert spark.read.parquet(table).count() == 3


TELEMETRY = "Plant,,,,,,,\nUnit,,,,,,,\n,,,,,,,\nx,,,,,,,\nTime,a,b,c,d,e,f,g\n{rows}"


def test_telemetry_folder_and_ledger(spark, tmp_path):
    landed, table, names = tmp_path / "landed", str(tmp_path / "table"), str(tmp_path / "ledger")
    landed.mkdir()
    (landed / "day1.csv").write_text(TELEMETRY.format(rows="2025-01-05 06:00:00,1,10.5,,2,3,4,5\n,1,1,1,1,1,1,1\n"))
    feed_loads.load_telemetry(spark, str(landed), table, names)
    (landed / "day2.csv").write_text(TELEMETRY.format(rows="06.01.2025 07:00,1,11,1,2,3,4,bad\n"))
    for _ in range(2):
        feed_loads.load_telemetry(spark, str(landed), table, names)
    got = rows(spark.read.parquet(table), "ts", "feed", "coal", "slag")
    assert got == [(dt.datetime(2025, 1, 5, 6), 10.5, None, 5.0), (dt.datetime(2025, 1, 6, 7), 11.0, 1.0, None)]
    assert rows(spark.read.parquet(names), "source_file") == [("day1.csv",), ("day2.csv",)]


def test_rows_stored_without_ledger_entry_are_not_repeated(spark, tmp_path):
    landed, table = tmp_path / "landed", str(tmp_path / "table")
    landed.mkdir()
    (landed / "day1.csv").write_text(TELEMETRY.format(rows="2025-01-05 06:00:00,1,1,1,1,1,1,1\n"))
    feed_loads.load_telemetry(spark, str(landed), table, str(tmp_path / "ledger"))
    # The ledger of the first run is lost.
    feed_loads.load_telemetry(spark, str(landed), table, str(tmp_path / "ledger2"))
    assert spark.read.parquet(table).count() == 1


def test_json_ledger(spark, tmp_path):
    (tmp_path / "files.json").write_text('["a.xlsx", "b.xlsx"]')
    known = ledger.read_json_ledger(spark, str(tmp_path / "files.json"))
    seen = spark.createDataFrame([("a.xlsx", 1), ("c.xlsx", 2)], "source_file STRING, v INT")
    assert rows(ledger.pending_rows(seen, known), "source_file") == [("c.xlsx",)]


def test_calendar(spark):
    assert [r[0] for r in rows(cal.months(spark, "2025-01-15", "2025-03-31"))] == [day("2025-02-01"), day("2025-03-01")]
    assert cal.days(spark, "2024-02-28", "2024-03-01").count() == 3
    assert cal.months(spark, "2025-01-02", "2025-01-31").count() == 0


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a INT, b STRING")
    assert quality.drop_empty_columns(df).columns == ["a"]
    assert read_or_empty(spark, "/tmp/planact-nothing-here", schemas.MATERIAL).isEmpty()
    assert rows(df.select(F.lit(1).alias("x"))) == [(1,), (1,)]


def test_years_are_all_kept_unless_named(spark, tmp_path):
    book = grids.read_workbook(spark, **sheets(tmp_path))
    assert ("V1", "1110203", day("2019-01-01"), "budget", 7.0) in rows(book["budget"])
    assert ("V1", day("2031-01-10"), "budget", 24.0) in rows(book["budget_shutdown"])
    columns = ["x", "2025-01-01 00:00:00", "2019-01-01 00:00:00"]
    assert grids.months_left_out(columns, YEARS) == [columns[2]] and grids.months_left_out(columns, None) == []


FILES = {
    "a.csv": "BpzIdt,MatIdt,MatArt,LPlzIdt,BucDat,MngD\nd1,M1,ROH,55,2025-01-05,\"-1,5\"\n",
    "b.csv": "'MngD ',MatIdt,BpzIdt,'LPlzIdt',BucDat,extra,MatArt\n-2,M2,d2,53,2025-01-06,\"x, y\",ROH\n",
    "c.csv": "MatIdt,BpzIdt,BucDat,MngD\nM3,d3,2025-03-07,bad\n",
}
EXPECTED = [
    ("d1", "M1", day("2025-01-05"), "ROH", 55, -1.5), ("d2", "M2", day("2025-01-06"), "ROH", 53, -2.0),
    ("d3", "M3", day("2025-03-07"), " ", -1, 0.0),
]
CORE = ["BpzIdt", "MatIdt", "BucDat", "MatArt", "LPlzIdt", "MngD"]


def test_every_movement_file_is_read_by_its_own_header(spark, tmp_path):
    landed, table = tmp_path / "landed", str(tmp_path / "table")
    landed.mkdir()
    for name, text in FILES.items():
        (landed / name).write_text(text)
    load = feed_loads.load_movements(spark, str(landed), table)
    assert (load.rows, load.stored, load.bad_cells) == (3, 3, {"MngD": 1})
    assert load.missing_columns["MatArt"] == ["c.csv"] and load.missing_columns["Zn"] == ["a.csv", "b.csv", "c.csv"]
    assert rows(spark.read.parquet(table), *CORE) == EXPECTED
    (landed / "d.csv").write_text("1,2,3\n")
    with pytest.raises(Exception, match="no header in movement file"):
        feed_loads.load_movements(spark, str(landed), table)


def test_only_new_telemetry_files_are_read(spark, tmp_path):
    landed, args = tmp_path / "landed", (str(tmp_path / "table"), str(tmp_path / "ledger"))
    landed.mkdir()
    (landed / "day1.csv").write_text(TELEMETRY.format(rows="2025-01-05 06:00:00,1,1,1,1,1,1,1\n"))
    assert feed_loads.load_telemetry(spark, str(landed), *args) == 1
    # The loaded file becomes unreadable as text of a feed; nobody looks into it again.
    (landed / "day1.csv").write_text("changed")
    (landed / "day2.csv").write_text(TELEMETRY.format(rows="2025-01-06 06:00:00,1,2,1,1,1,1,1\n"))
    assert feed_loads.load_telemetry(spark, str(landed), *args) == 1
    assert feed_loads.load_telemetry(spark, str(landed), *args) == 0
    assert rows(spark.read.parquet(args[0]), "feed") == [(1.0,), (2.0,)]


def test_interrupted_replacement(spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "k STRING, v INT"
    one = spark.createDataFrame([("a", 1)], ddl)
    sink.upsert_table(spark, path, one.schema, one, ["k"])
    # Died after the old table was moved away and before the new one took its place.
    (tmp_path / "t").rename(tmp_path / "t.old")
    spark.createDataFrame([("x", 0)], ddl).write.parquet(path + ".new")
    sink.upsert_table(spark, path, one.schema, spark.createDataFrame([("b", 2)], ddl), ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
