import datetime as dt

from conftest import day, rows

from planact.operators import asof, plan

MATS = (("M1", "one", "Cons", "H"), ("M2", "two", "Cons", "N"))
JAN = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 31, 23, 59)


def _one(make, *shutdown):
    return (
        make.plan(("V", "M1", "2025-01-01", "budget", 744), ("V", "M1", "2025-01-01", "forecast", 0)),
        make.shutdown(*shutdown),
        make.materials(*MATS),
    )


def test_full_day_shutdown(make):
    args = _one(make, ("V", "2025-01-10", "budget", 24))
    got = {r[0]: r[1:] for r in rows(plan.allocate_months(*args), "day", "budget", "forecast")}
    assert len(got) == 31
    assert got[day("2025-01-10")] == (0.0, 0.0)
    assert all(v == (24.792, 0.0) for d, v in got.items() if d != day("2025-01-10"))
    # The same month asked for as an interval gives the same days.
    assert rows(plan.allocate_interval(*args, *JAN, version="V"), "day", "budget", "forecast") == rows(
        plan.allocate_months(*args), "day", "budget", "forecast"
    )


def test_partial_shutdown(make):
    args = _one(make, ("V", "2025-01-10", "budget", 16), ("V", "2025-01-11", "budget", 8))
    got = {r[0]: r[1] for r in rows(plan.allocate_months(*args), "day", "budget")}
    assert got[day("2025-01-10")] == 8.264 and got[day("2025-01-11")] == 16.528


def test_prorated_total(make):
    args = _one(make, ("V", "2025-01-10", "budget", 24))
    slices = plan.monthly_slices(plan.monthly_plan(args[0]), args[2])
    assert rows(plan.prorated_totals(slices, *JAN)) == [("V", 743.983, 0.0)]
    assert rows(plan.full_month_totals(slices), "budget_total") == [(743.983,)]


def test_mid_month_start_drops_that_month(make):
    facts = make.plan(("V", "M1", "2025-01-01", "budget", 744), ("V", "M1", "2025-02-01", "budget", 672))
    slices = plan.monthly_slices(plan.monthly_plan(facts), make.materials(*MATS))
    got = plan.prorated_totals(slices, dt.datetime(2025, 1, 2), dt.datetime(2025, 2, 14, 23, 59))
    assert rows(got, "budget_total") == [(335.983,)]


def test_no_shutdown_row_or_no_plan_means_no_days(make):
    facts, _, mats = _one(make)
    assert rows(plan.allocate_months(facts, make.shutdown(), mats)) == []
    assert rows(plan.allocate_months(facts, make.shutdown(("V", "2025-01-10", "budget", 0)), mats)) == []
    zero = make.plan(("V", "M1", "2025-01-01", "budget", 0))
    assert rows(plan.allocate_months(zero, make.shutdown(("V", "2025-01-10", "budget", 5)), mats)) == []


def test_almost_all_hours_down_keeps_three(make):
    downs = [("V", f"2025-01-{d:02d}", "budget", 24) for d in range(1, 32)]
    got = rows(plan.allocate_months(*_one(make, *downs)), "budget")
    assert len(got) == 31 and set(got) == {(0.0,)}


def test_rounding_is_on_the_slice(make):
    """Allocating the sum is not the sum of the allocations."""
    facts = make.plan(
        ("V", "M1", "2025-01-01", "budget", "0.30"), ("V", "M2", "2025-01-01", "budget", "0.30"),
        ("V", "XX", "2025-01-01", "budget", "999"),
    )
    down, mats = make.shutdown(("V", "2025-01-10", "budget", 4)), make.materials(*MATS)
    whole = rows(plan.allocate_months(facts, down, mats), "budget")
    parts = rows(plan.allocate_months(facts, down, mats, by=["category"]), "category", "budget")
    assert set(whole) == {(0.024,), (0.02,)}
    assert {p[1] for p in parts} == {0.0}


def test_unpivot_and_pivot(make, spark):
    wide = spark.createDataFrame([("M1", 5.0, None)], "material_id STRING, b_jan_25 DOUBLE, b_feb_25 DOUBLE")
    long = plan.unpivot_months(wide, ["material_id"])
    assert rows(long, "month", "measure", "value") == [
        (day("2025-01-01"), "budget", 5.0), (day("2025-02-01"), "budget", 0.0)
    ]
    back = plan.pivot_months(long, ["material_id"], [day("2025-01-01"), day("2025-02-01")])
    assert rows(back, "material_id", "b_jan_25", "b_feb_25") == [("M1", 5.0, 0.0)]
    assert rows(plan.unpivot_months(back, ["material_id"]).where("measure = 'budget'")) == rows(long)


def test_shutdown_frames(make):
    down = make.shutdown(("V", "2025-01-10", "budget", 4), ("V", "2025-01-10", "forecast", 6), ("W", "2025-01-11", "budget", 1),
                         ("V", "2025-02-01", "budget", 2), ("V", "2025-01-12", "budget", 0))
    assert rows(plan.shutdown_between(down, "2025-01-01", "2025-01-31", "V")) == [("V", day("2025-01-10"), 4.0, 6.0)]
    assert rows(plan.shutdown_totals(down)) == [("V", 6.0, 6.0), ("W", 1.0, 0.0)]


def test_pooled_versions(make):
    facts = make.plan(("A", "M1", "2025-01-01", "budget", 372), ("B", "M1", "2025-01-01", "budget", 372))
    down = make.shutdown(("A", "2025-01-10", "budget", 12), ("B", "2025-01-10", "budget", 12))
    got = {r[0]: r[1] for r in rows(plan.allocate_interval(facts, down, make.materials(*MATS), *JAN), "day", "budget")}
    assert got[day("2025-01-10")] == 0.0 and got[day("2025-01-09")] == 24.792


def test_wide_rows_and_lists_are_made_after_the_shuffle(make):
    """No task holds the wide rows or lists of ids whose other cells lie elsewhere."""
    facts = make.plan(("V0", "1", "2025-01-01", "budget", 1), ("V0", "2", "2025-02-01", "forecast", 2))
    made = {
        "pivotfirst": [plan.pivot_months(facts, ["material_id"], [day("2025-01-01")])],
        "collect_list": [plan.plan_by_month_map(facts), asof.plan_as_known(facts, ["2024-06-01"])],
    }
    for name, frames in made.items():
        for df in frames:
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in text[text.index(name) : text.index(f"partial_{name}")]
