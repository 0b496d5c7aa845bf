"""Runs against dense series, and the plan as known against a look at every row."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from planact import schemas
from planact.operators import asof, runs

FIRST, LAST = day("2025-01-01"), day("2025-02-09")
DAYS = [FIRST + dt.timedelta(days=i) for i in range((LAST - FIRST).days + 1)]


@pytest.fixture(scope="module")
def series():
    """Values of some materials by day: short and long runs, zeros, edges, one that never moved."""
    draw, out = random.Random(4), {}
    for m in ("A", "B", "C", "D"):
        value = 0
        for d in DAYS:
            if draw.random() < 0.3:
                value = draw.choice([0, 0, 5, -5, 7])
            if value or draw.random() < 0.2:
                out[m, d] = value
    out.update({("E", DAYS[0]): 1, ("E", DAYS[-1]): 1, **{("F", d): 3 for d in DAYS}, ("G", DAYS[3]): 0})
    return out


@pytest.fixture(scope="module")
def coded(spark, series):
    moved = spark.createDataFrame([(m, d, v) for (m, d), v in series.items()], "material_id string, day date, tenths long")
    outside = [("A", FIRST - dt.timedelta(days=1), 9), ("A", LAST + dt.timedelta(days=1), 9), ("unknown", FIRST, 9)]
    moved = moved.unionByName(spark.createDataFrame(outside, moved.schema))
    everyone = spark.createDataFrame([(m, f"name {m}") for m in "ABCDEFGH"], "material_id string, material_name string")
    return runs.coded(moved, everyone, F.lit(FIRST), F.lit(LAST), "tenths")


def test_runs_are_the_changes_of_the_dense_series(coded, series):
    expected = []
    for m in "ABCDEFGH":
        begin = DAYS[0]
        for d, after in zip(DAYS, [*DAYS[1:], None]):
            value = series.get((m, d), 0)
            if after is None or series.get((m, after), 0) != value:
                expected.append((m, f"name {m}", begin, d, value))
                begin = after
    assert rows(coded) == sorted(expected, key=repr)


def test_decoding_an_interval(coded, series):
    lo, hi = DAYS[9], DAYS[17]
    dense = runs.decoded(coded, F.lit(lo), F.lit(hi))
    expected = [(d, m, series.get((m, d), 0)) for m in "ABCDEFGH" for d in DAYS[9:18]]
    assert rows(dense, "day", "material_id", "tenths") == sorted(expected, key=repr)
    assert runs.decoded(coded, F.lit(day("2026-01-01")), F.lit(day("2026-02-01"))).count() == 0


def test_runs_group_by_material_once(coded):
    text = coded._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_plan_as_known(spark):
    draw = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    facts = [
        (f"V{draw.randint(0, 5)}", m, day(mo), me, None if draw.random() < 0.2 else Decimal(draw.randint(0, 9)), start + dt.timedelta(hours=draw.randint(0, 99)))
        for m in ("A", "B", None) for mo in ("2025-01-01", "2025-02-01") for me in ("budget", "forecast") for _ in range(draw.randint(0, 12))
    ]
    times = [start + dt.timedelta(hours=h) for h in (50, -1, 0, 20, 99, 50, 1000)]
    df = spark.createDataFrame(facts, schemas.PLAN_FACT)
    expected = []
    for t in sorted(set(times)):
        for cell in {f[1:4] for f in facts if f[1] is not None}:
            known = [(f[5], f[4], f[0]) for f in facts if f[1:4] == cell and f[4] is not None and f[5] <= t]
            if known:
                _, value, version = max(known)
                expected.append((t, *cell, float(value), version))
    assert rows(asof.plan_as_known(df, times)) == sorted(expected, key=repr)
    assert rows(asof.plan_as_known(df, [t.isoformat() for t in times])) == sorted(expected, key=repr)
    assert asof.plan_as_known(df, []).count() == 0
    text = asof.plan_as_known(df, times)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Window" not in text
