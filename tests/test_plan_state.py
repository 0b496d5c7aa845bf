"""The maintained plan state against recomputation from history."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import day, rows
from test_loads import YEARS, sheets

from planact import schemas
from planact.operators import change, state
from planact.plans import plan_load, plan_state
from planact.sinks import tables as sink

MONTHS = ["2024-11-01", "2024-12-01", "2025-01-01", "2025-02-01"]


def plan_rows(spark, version, seed, stamp, missing=0.2):
    draw = random.Random(seed)
    data = [
        (version, m, day(mo), me, None if draw.random() < missing else Decimal(draw.choice(["0", "1.5", "100", "100.001"])), dt.datetime.fromisoformat(stamp))
        for m in ["A", "B", " B", "C", f"only {version}"] for mo in MONTHS for me in ("budget", "forecast") if draw.random() < 0.7
    ]
    return spark.createDataFrame(data, schemas.PLAN_FACT)


def shutdown_rows(spark, version, seed, stamp):
    draw = random.Random(seed)
    data = [
        (version, day(f"2025-01-0{d}"), me, draw.choice([0.0, 1.0, 2.0, 24.0]), dt.datetime.fromisoformat(stamp))
        for d in range(1, 8) for me in ("budget", "forecast") if draw.random() < 0.6
    ]
    return spark.createDataFrame(data, schemas.SHUTDOWN_FACT)


@pytest.fixture(scope="module")
def loads(spark):
    stamps = {"V0": "2024-01-01", "V1": "2024-03-01", "V2": "2024-02-01", "V3": "2024-03-01"}
    return {v: (plan_rows(spark, v, i, t), shutdown_rows(spark, v, i, t)) for i, (v, t) in enumerate(stamps.items())}


def merged(spark, loads, tables, versions):
    for v in versions:
        plan_state.merge(spark, tables, *loads[v], [v])
    facts, down = loads[versions[0]]
    for v in versions[1:]:
        facts, down = facts.unionByName(loads[v][0]), down.unionByName(loads[v][1])
    return facts, down


def test_state_is_the_latest_of_history(spark, loads, tmp_path):
    """Loads out of the order of their times, two at one time, and one merged twice."""
    tables = plan_state.StateTables(str(tmp_path))
    facts, down = merged(spark, loads, tables, ["V1", "V0", "V3", "V2"])
    plan_state.merge(spark, tables, *loads["V0"], ["V0"])
    plan, shutdown = plan_state.read(spark, tables)
    assert rows(plan.where("value is not null").select(*change.CELL, "value")) == rows(change.latest_values(facts))
    assert rows(change.latest_versions(plan)) == rows(change.latest_versions(facts))
    assert rows(change.materials_in_plan(plan)) == rows(change.materials_in_plan(facts))
    assert rows(shutdown.select("day", "measure", "hours")) == rows(change.latest_shutdown(down))
    fresh = state.digests(plan)
    assert rows(state.differing(fresh, spark.read.parquet(tables.plan_digests))) == []
    assert plan_state.changed_months(spark, tables, loads["V3"][0]).count() > 0


@pytest.fixture(scope="module")
def stored(spark, loads, tmp_path_factory):
    """The state of three loads, and their facts."""
    tables = plan_state.StateTables(str(tmp_path_factory.mktemp("state")))
    return tables, *merged(spark, loads, tables, ["V0", "V1", "V2"])


@pytest.mark.parametrize("new", ["V3", "V2", "same"])
def test_decision_from_the_state_is_that_from_history(spark, loads, stored, new):
    tables, facts, down = stored
    plan, shutdown = plan_state.read(spark, tables)
    fresh = plan.withColumn("version", plan.version).select("version", *change.CELL, "value") if new == "same" else loads[new][0]
    fresh_down = loads["V1" if new == "same" else new][1]
    known = state.Known(frozenset({"V0", "V1", "V2"}), False)
    for calendar in (None,) if new == "V2" else (spark.createDataFrame([(2025, 1, 1, d, d == 0) for d in range(0, 6)] + [(2024, 4, 12, 0, True)], schemas.TIME_MEMBER),):
        old = change.load_decision(fresh, fresh_down, facts, down, calendar)
        got = state.decision(fresh, fresh_down, plan, shutdown, known, calendar)
        assert rows(got.flags, *old.flags.columns) == rows(old.flags)
        for name in ("new_materials", "changed_versions", "changed_cells", "changed_shutdown"):
            expected = getattr(old, name)
            assert rows(getattr(got, name), *expected.columns) == rows(expected), name


def test_an_empty_store(spark, loads, tmp_path):
    tables = plan_state.StateTables(str(tmp_path))
    known = plan_state.refresh(spark, tables, str(tmp_path / "plan"), str(tmp_path / "shutdown"))
    assert known == state.Known(frozenset(), True)
    flags = state.decision(*loads["V0"], *plan_state.read(spark, tables), known).flags.first()
    assert flags.store_empty and flags.should_load and not flags.version_in_use


def test_a_merge_that_was_cut_off_is_made_up_for(spark, loads, tmp_path):
    """Facts of two loads are stored, one of them never reached the state."""
    tables, plan, down = plan_state.StateTables(str(tmp_path)), str(tmp_path / "plan"), str(tmp_path / "shutdown")
    for v in ("V0", "V1"):
        sink.append_plan(loads[v][0], plan)
        sink.append_shutdown(loads[v][1], down)
    plan_state.merge(spark, tables, *loads["V0"], ["V0"])
    known = plan_state.refresh(spark, tables, plan, down)
    assert known == state.Known(frozenset({"V0", "V1"}), False)
    facts = spark.read.schema(schemas.PLAN_FACT).parquet(plan)
    assert rows(change.latest_versions(plan_state.read(spark, tables)[0])) == rows(change.latest_versions(facts))
    assert rows(plan_state.equal_versions(spark, tables, loads["V1"][0])) == [("V1",)]


def test_equal_versions_are_told_by_digests(spark, loads, stored):
    tables = stored[0]
    shuffled = loads["V0"][0].withColumn("version", loads["V0"][0].material_id).repartition(5)
    assert rows(plan_state.equal_versions(spark, tables, shuffled)) == [("V0",)]
    assert rows(plan_state.equal_versions(spark, tables, shuffled.where("material_id <> 'A'"))) == []
    more = shuffled.unionByName(shuffled.limit(1))
    assert rows(plan_state.equal_versions(spark, tables, more)) == []


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cell_is_shuffled_for_digests(spark, loads, tmp_path):
    """The only exchange of the new plan's side carries one row per (month, measure) and map task."""
    path = str(tmp_path / "new")
    loads["V0"][0].write.parquet(path)
    text = physical(state.digests(spark.read.schema(schemas.PLAN_FACT).parquet(path)))
    exchange = text.index("Exchange hashpartitioning(month")
    assert text.count("Exchange") == 1 and "partial_sum" in text[exchange:] and "material_id" not in text[exchange : exchange + 60]


def test_a_decision_reads_each_side_once(spark, loads, stored, tmp_path):
    tables, path = stored[0], str(tmp_path / "new")
    loads["V2"][0].write.parquet(path)
    plan, shutdown = plan_state.read(spark, tables)
    fresh = spark.read.schema(schemas.PLAN_FACT).parquet(path)
    text = physical(state._per_measure(fresh, plan, None))
    assert text.count("FileScan") == 2 and text.count("Exchange hash") <= 3
    assert physical(state._days(loads["V2"][1], shutdown, None)).count("FileScan") == 1


def test_a_load_counts_what_it_leaves_out(spark, tmp_path):
    store = plan_load.PlanStore(str(tmp_path / "store"))
    done = plan_load.load_workbook(spark, sheets(tmp_path), store, YEARS)
    stored = spark.read.schema(schemas.PLAN_FACT).parquet(store.plan)
    counts = done.counts
    assert counts["rows"] - counts["unknown_material"] - counts["unknown_month"] == stored.count()
    assert set(counts) == {"rows", "unknown_material", "unknown_month", "empty_cells"}
    known = plan_state.refresh(spark, store.state, store.plan, store.shutdown)
    assert known.versions and not known.empty
    assert rows(plan_state.read(spark, store.state)[0].select(*change.CELL, "value")) == rows(change.latest_values(stored))
    # The flags and findings are those of the moment before the load.
    assert done.flags.first()["store_empty"] and done.changed_cells.count() > 0
    again = plan_load.load_workbook(spark, sheets(tmp_path), store, YEARS)
    assert not again.should_load() and again.flags.first()["version_in_use"] and again.counts == {}
