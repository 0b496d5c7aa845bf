import pytest
from conftest import day, rows

from planact.plans import category_sums, combined, daily_report, legacy_report, material_report
from planact.sinks import reports

MATS = (
    ("M1", "one", "Cons", "H"), ("M2", "two", "Cons", "N"), ("M3", "three", "Others", "RI"), ("M4", "four", "Paste", "P")
)
MOVES = (
    ("M1", "2025-01-05", "ROH", 55, -10_000), ("M2", "2025-01-05", "ROH", 53, -5_000), ("M3", "2025-01-06", "ROH", 55, -4_000),
    ("M4", "2025-02-01", "ROH", 55, -9_000), ("K", "2025-01-05", "KRSM", 55, -2_400), ("F", "2025-01-05", "HIBE", 53, -3_000),
)
PLAN = (("V", "M1", "2025-01-01", "budget", 744), ("V", "M2", "2025-01-01", "forecast", 744))
DOWN = (("V", "2025-01-10", "budget", 24), ("V", "2025-01-10", "forecast", 24))
TELEMETRY = (
    ("2025-01-05T06:00", 1, 48, 1, 2, 3, "4.8"),
    ("2025-01-06T05:59", 1, 24, 1, None, 3, None),
    ("2025-01-06T06:00", 0, 24, 1, 2, 3, 1),
    ("2025-02-01T12:00", 1, 24, 1, 2, 3, 1),
)


@pytest.fixture
def data(make):
    return make.inputs(MATS, MOVES, PLAN, DOWN, TELEMETRY)


def test_daily_report(data):
    got = {r[0]: r[1:] for r in rows(daily_report.daily_report(data, "2025-01-01", "2025-01-31", "V"))}
    assert len(got) == 31
    # 25 t planned; 10 t at the main place; 10/10 and 5/10 of it; 5 + 3 + 2 dust and coal + 2 t; flux 3 t
    assert got[day("2025-01-05")] == (25.0, 25.0, 10.0, 100.0, 50.0, 0.0, 0.0, 0.0, 12.0, 3.0, 8.3, 3.0, 0.2)
    assert got[day("2025-01-06")] == (25.0, 25.0, 4.0, 0.0, 0.0, 100.0, 0.0, 0.0, 6.0, 0.0, 0.0, 1.0, 0.0)
    assert got[day("2025-01-10")] == (0.0,) * 13
    assert got[day("2025-01-07")] == (25.0, 25.0) + (0.0,) * 11


def test_days_outside_the_month_have_telemetry_only(data):
    got = {r[0]: r[1:] for r in rows(daily_report.daily_report(data, "2025-01-31", "2025-02-03", "V"))}
    assert set(got) == {day("2025-01-31"), day("2025-02-01")}
    assert got[day("2025-02-01")][:3] == (None, None, 0.0)
    assert got[day("2025-02-01")][9:] == (0.0, 4.2, 1.0, 0.0)


def test_no_plan_no_report(make):
    data = make.inputs(MATS, MOVES, PLAN, (), TELEMETRY)
    assert rows(daily_report.daily_report(data, "2025-01-01", "2025-01-31", "V")) == []


def test_complete_days(make, data):
    moved_only = make.inputs(MATS, (("M1", "2025-01-20", "ROH", 55, -8_000),), PLAN, DOWN, TELEMETRY)
    plain = {r[0]: r[1] for r in rows(daily_report.daily_report(moved_only, "2025-01-01", "2025-01-31", "V"), "day", "actual")}
    full = {
        r[0]: r[1]
        for r in rows(daily_report.daily_report(moved_only, "2025-01-01", "2025-01-31", "V", complete_days=True), "day", "actual")
    }
    assert plain[day("2025-01-20")] == 0.0 and full[day("2025-01-20")] == 8.0 and len(full) == 31


def test_text(data):
    numbers = daily_report.daily_numbers(data, "2025-01-05", "2025-01-07", "V")
    got = {r[0]: r for r in [tuple(x) for x in daily_report.render(numbers).collect()]}
    assert got["2025-01-05"][:5] == ("2025-01-05", "25", "25", "10", "100.0 %")
    assert got["2025-01-06"][4] == "0.0 %" and got["2025-01-06"][11] == "0.0 %"
    assert got["2025-01-07"][4] == "0 %" and got["2025-01-07"][11] == "0 %"


def test_history_is_the_same_month_by_month(data):
    one = rows(daily_report.daily_report(data, "2025-01-01", "2025-01-31", "V"))
    every = rows(daily_report.daily_history(data).where("version = 'V'").drop("version"))
    assert every == one


def test_category_sums(data):
    got = {r[0]: r[1:] for r in rows(category_sums.category_sums(data, "2025-01-05", "2025-01-10", "V"))}
    assert len(got) == 11
    assert got["Paid Raw Materials"] == (123.96, 123.96, 19.0)
    assert got["Category H"] == (123.96, 0.0, 10.0)
    assert got["Category N"] == (0.0, 123.96, 5.0)
    # No plan: the actual reads 0 as well.
    assert got["Category RI"] == (0.0, 0.0, 0.0) and got["Delta Paste"] == (0.0, 0.0, 0.0)


def test_category_sums_history(data):
    got = {r[2]: r[3:] for r in rows(category_sums.category_sums_history(data))}
    one = {r[0]: r[1:] for r in rows(category_sums.category_sums(data, "2025-01-01", "2025-01-31", "V"))}
    assert got == one


def test_material_report(data):
    got = rows(material_report.material_report(data, "2025-01-05", "2025-01-10", "V"))
    assert len(got) == 4 * 6
    cells = {(r[0], r[2]): r[5:] for r in got}
    assert cells[day("2025-01-05"), "M1"] == (24.792, 0.0, 10.0)
    assert cells[day("2025-01-10"), "M1"] == (0.0, 0.0, 0.0)
    # Without a defined plan the actual stays.
    assert cells[day("2025-01-06"), "M3"] == (0.0, 0.0, 4.0)


def test_legacy_report(data):
    got = {r[0]: r[1:] for r in rows(legacy_report.legacy_rows(data, "2025-01-04", "2025-01-05"))}
    assert got[day("2025-01-04")] == ("0 t", "0 %", "0 %", "0 %", "0 %", "0 %", "0 t")
    assert got[day("2025-01-05")] == ("10 t", "100.0 %", "50.0 %", "0.0 %", "0.0 %", "0.0 %", "3 t")


def test_combined_report(spark, data, tmp_path):
    written = combined.write_combined_report(data, "2025-01-05", "2025-01-10", "V", str(tmp_path))
    assert set(written) == {"report", "category_sums", "report_per_material"}
    assert written["report"] == f"{tmp_path}/Report_2025-01-05_2025-01-10/report"
    apart = daily_report.daily_report(data, "2025-01-05", "2025-01-10", "V")
    assert rows(spark.read.parquet(written["report"])) == rows(apart)
    params = rows(spark.read.parquet(written["report"] + "_params"))
    assert ("Version Name:", "V") in params and ("Start Date:", "2025-01-05 00:00") in params


def test_empty_parts_are_skipped(make, spark, tmp_path):
    data = make.inputs(MATS, MOVES, PLAN, (), TELEMETRY)
    written = combined.write_combined_report(data, "2025-01-05", "2025-01-06", "V", str(tmp_path))
    assert set(written) == {"category_sums", "report_per_material"}
    as_csv = reports.write_report(str(tmp_path), "2025-01-01", "2025-01-02", combined.parameters(spark, "2025-01-01", "2025-01-02", "V"),
                                  {"sums": category_sums.category_sums(data, "2025-01-05", "2025-01-06", "V")}, fmt="csv")
    assert set(as_csv) == {"sums"}
