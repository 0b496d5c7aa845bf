"""Rows of the plan move once: sheets, states, decisions and slices do not shuffle them again."""

import datetime as dt
import re

from conftest import day, rows
from pyspark.sql import functions as F

from planact import schemas
from planact.catalog import CATALOG
from planact.operators import change, plan, state
from planact.plans import plan_state, stored_history
from planact.sources import star_views as sv

MONTHS = ("2025-01-01", "2025-02-01", "2026-01-01")
MATS = [("A", "first", "Cons", "H"), ("B", "second", "Others", "RI")]


def facts_of(make, *more, version="V0", stamp="2024-01-01"):
    cells = [(version, a, m, k, 10 * i) for a in "AB" for i, m in enumerate(MONTHS) for k in ("budget", "forecast")]
    return make.plan(*cells, *more, stamp=stamp)


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+\(.*?\), \w+)", text)


def test_cells_of_a_wide_plan_are_shuffled_once(make):
    assert len(exchanges(plan.pivot_months(facts_of(make), ["material_id"], [day(m) for m in MONTHS]))) == 1


def test_a_state_is_merged_in_the_spread_it_is_written_in(spark, make, tmp_path):
    facts, tables = facts_of(make), plan_state.StateTables(str(tmp_path))
    spread = facts.withColumn("part_year", F.year("month")).repartition("part_year")
    assert len(exchanges(state.plan_state(spread, "part_year"))) == 1
    down = make.shutdown(("V0", "2025-01-10", "budget", 4))
    plan_state.merge(spark, tables, facts, down, ["V0"])
    later = make.plan(("V1", "A", "2025-02-01", "budget", 77), stamp="2024-02-01")
    plan_state.merge(spark, tables, later, down.limit(0), ["V1"])
    columns = [c for c in schemas.PLAN_STATE.fieldNames() if c != "part_year"]
    stored = spark.read.schema(schemas.PLAN_STATE).parquet(tables.plan)
    assert rows(stored, *columns) == rows(state.plan_state(facts.unionByName(later)), *columns)
    for year in (2025, 2026):
        found = [tuple(r) for r in stored.where(F.col("part_year") == year).coalesce(1).select("material_id", "measure", "month").collect()]
        assert found and found == sorted(found)


def test_months_with_equal_digests_are_decided_without_their_cells(spark, make):
    """January is as stored, February has a changed, an emptied and a repeated cell, 2027 is new; one material left."""
    facts = facts_of(make, ("V0", "C", "2025-01-01", "budget", 5), ("V0", "B", "2025-01-01", "forecast", None))
    new = make.plan(
        *[("V1", a, "2025-01-01", k, None if a == "B" else 0) for a in "AB" for k in ("budget", "forecast")],
        ("V1", "A", "2025-02-01", "budget", 11), ("V1", "B", "2025-02-01", "budget", None), ("V1", "A", "2025-02-01", "budget", 10),
        ("V1", "A", "2027-01-01", "budget", 3), ("V1", "D", "2027-01-01", "forecast", None), ("V1", "A", "2028-01-01", "budget", 4),
    )
    down = make.shutdown(("V0", "2025-01-10", "budget", 4))
    dim = spark.createDataFrame([(y, 1, m, 0, True) for y, m in ((2025, 1), (2025, 2), (2026, 1), (2027, 1))], schemas.TIME_MEMBER)
    stored, known = state.plan_state(facts), state.Known(frozenset({"V0"}), False)
    args = (new, down, stored, state.shutdown_state(down), known, dim)
    whole, short = state.decision(*args), state.decision(*args, state.digests(stored))
    history = change.load_decision(new, down, facts, down, dim)
    for name in ("flags", "changed_cells", "changed_versions", "new_materials", "changed_shutdown"):
        found = rows(getattr(history, name))
        assert rows(getattr(whole, name), *getattr(history, name).columns) == found, name
        assert rows(getattr(short, name), *getattr(history, name).columns) == found, name
    assert len(rows(short.changed_cells)) == 3
    # Of the stored pairs only the budget of January (C is missing) and of February are looked at cell by cell.
    looked = rows(state._stored_pairs(new, state.digests(stored)).where("look"), "month", "measure")
    assert looked == [(day("2025-01-01"), "budget"), (day("2025-02-01"), "budget")]


def test_slices_of_the_plan_are_summed_where_rows_meet_their_material(make):
    facts = facts_of(make, ("V0", "X", MONTHS[0], "budget", 1), ("V0", None, MONTHS[0], "budget", 1), ("V1", "A", MONTHS[0], "budget", None))
    for by in ([], ["category"], ["material_id", "material_type"]):
        materials = make.materials(*MATS, MATS[1])
        made = plan.plan_slices(facts, materials, by)
        assert rows(made) == rows(plan.monthly_slices(plan.monthly_plan(facts), materials, by), *made.columns)
    down = make.shutdown(("V0", "2025-01-10", "budget", 4))
    spread = exchanges(plan.allocate_months(facts, down, make.materials(*MATS)))
    assert spread and not [x for x in spread if "version" in x and "material_id" in x]


def star(spark, folder):
    at = dt.datetime(1998, 1, 5)
    tables = {
        "part": [(1, "steel", "b", "ECONOMY", 3, 1.0), (2, "tin", "b", "LARGE", 4, 1.0)],
        "supplier": [(3, "s", 1, 0.0)],
        "orders": [(k, 1, "FOP"[k % 3], 1.0, at + dt.timedelta(days=20 * k), "1") for k in range(6)],
        "lineitem": [(k, 1 + k % 2, 3, 1, 5.0, 10.0 + k, 0.1, 0.0, "R", "O", at + dt.timedelta(days=20 * k)) for k in range(6)],
        "events": [(1, dt.datetime(2024, 1, 5, 8), 1, "view", 2.0, "{}")],
    }
    for name, data in tables.items():
        spark.createDataFrame(data, sv.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_stored_report_reads_a_stored_plan(spark, tmp_path, monkeypatch):
    """Noting the months and both refreshes read the plan that was made once."""
    sf, seen, refresh = star(spark, tmp_path), [], stored_history.refresh

    def noted(spark, inputs, *rest):
        seen.append(inputs.plan.inputFiles())
        return refresh(spark, inputs, *rest)

    monkeypatch.setattr(stored_history, "refresh", noted)
    for name, whole in (("stored_daily_history", "daily_report_history"), ("stored_category_sums", "category_sums_history")):
        got = CATALOG[name].run(spark, sf)
        assert rows(got) == rows(CATALOG[whole].run(spark, sf).select(*got.columns))
    assert len(seen) == 4 and all(files and "lineitem" not in " ".join(files) for files in seen)


def test_a_sheet_begins_with_its_version_without_a_sort(spark, tmp_path):
    from planact.catalog import feed_queries
    from planact.sources import grids

    sf = star(spark, tmp_path)
    facts = feed_queries.sheet_facts(spark, sf)
    assert rows(facts.select("version").distinct()) == [("V1",)]
    grid = grids.read_plan_grid(spark, feed_queries.write_plan_sheet(spark, sf, "budget", str(tmp_path / "book"), facts))
    assert rows(grids.version_of(grid)) == [("V1",)]
    # A row for every material and month of the sheet, filled or not; the bad ids are left out.
    filled = rows(facts.where("measure = 'budget'"), "value")
    found = rows(grids.plan_rows(grid, "budget", F.lit("V1")), "material_id", "value")
    assert sorted((v,) for _, v in found if v is not None) == filled
    assert len(found) == len({m for m, _ in found}) * facts.select("month").distinct().count()
