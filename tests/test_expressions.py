import datetime as dt
from decimal import Decimal

import pytest
from conftest import day, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from planact.functions import cleaning, compare, dates, display, materials, rounding


def values(spark, data, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*columns).collect()]


def test_valid_ids(spark):
    ids = ["1110203", "111020", "2110203", "1110203-b", "1110203-H1", "111020-b", None]
    got = values(spark, [(i,) for i in ids], "id STRING", materials.is_valid_material_id(F.col("id")))
    assert [g[0] for g in got] == [True, False, False, True, True, False, False]


def test_types_and_short_ids(spark):
    ids = ["1110203", "1210203", "1310203", "123040506", "110203040"]
    got = values(
        spark,
        [(i,) for i in ids],
        "id STRING",
        materials.material_type_of(F.col("id")),
        materials.normalize_material_id(F.col("id")),
    )
    assert [g[0] for g in got] == ["Cons", "Paste", "Others", "Others", "Cons"]
    assert got[4][1] == "1123040"


def test_closeness(spark):
    pairs = [(None, 0.0), (100.0, 100.0005), (100.0, 100.01), (None, 5.0), (5.0, None), (None, None), (0.0, 1e-9)]
    got = values(spark, pairs, "a DOUBLE, b DOUBLE", compare.value_changed(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [False, False, True, True, True, False, True]


def test_dirty_numbers(spark):
    cells = ["1,5", "abc", None, " 2.25 ", "NaN", "1e400", "-1e400", "1,23456789"]
    got = values(spark, [(c,) for c in cells], "c STRING", cleaning.float_or_default(F.col("c")))
    assert [g[0] for g in got] == [1.5, 0.0, 0.0, 2.25, 0.0, 1.79e308, -1.79e308, 1.234568]
    got = values(spark, [("7.9",), ("x",), (None,), ("-3",)], "c STRING", cleaning.int_or_default(F.col("c")))
    assert [g[0] for g in got] == [7, -1, -1, -3]
    dates_in = ["2025-01-02 00:00:00", "2025-01-02", "02.01.2025", "soon", None]
    got = values(spark, [(c,) for c in dates_in], "c STRING", cleaning.date_or_default(F.col("c")))
    assert [g[0] for g in got] == [day("2025-01-02")] * 3 + [day("1970-01-01")] * 2


def test_production_day_starts_at_six(spark):
    stamps = [dt.datetime(2025, 1, 2, 5, 59), dt.datetime(2025, 1, 2, 6, 0)]
    got = values(spark, [(s,) for s in stamps], "ts TIMESTAMP_NTZ", dates.production_day(F.col("ts")))
    assert [g[0] for g in got] == [day("2025-01-01"), day("2025-01-02")]


def test_months_and_labels(spark):
    assert dates.header_month("2025-01-01 00:00:00") == day("2025-01-01")
    assert dates.header_month("Jan.25") == day("2025-01-01")
    assert dates.header_month("15.03.2026") == day("2026-03-01")
    assert dates.header_month("Sum") is None
    got = values(
        spark,
        [("jan_25",), ("feb_24",), ("nope",)],
        "c STRING",
        dates.month_from_label(F.col("c")),
        dates.month_label(dates.month_from_label(F.col("c"))),
    )
    assert got == [(day("2025-01-01"), "jan_25"), (day("2024-02-01"), "feb_24"), (None, None)]


def test_month_member_has_no_date(spark):
    got = values(spark, [(2025, 1, 0), (2025, 1, 9)], "y INT, m INT, d INT", dates.date_from_parts(F.col("y"), F.col("m"), F.col("d")))
    assert got == [(None,), (day("2025-01-09"),)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**15), 10**15), min_size=20, max_size=60))
def test_integer_rounding_is_half_even(spark, masses):
    """Against Python's decimal rounding, with ties mixed in."""
    masses = masses + [50_000_000 * k for k in range(-9, 10)] + [500_000_000 * k for k in range(-9, 10)]
    got = values(
        spark,
        [(m,) for m in masses],
        "mg BIGINT",
        "mg",
        rounding.abs_tenth_tons("mg"),
        rounding.signed_tenth_tons("mg"),
        rounding.abs_whole_tons("mg"),
    )
    for mg, tenths, signed, whole in got:
        tons = Decimal(mg) / 10**9
        assert tenths == abs(round(tons, 1)) * 10
        assert signed == round(tons, 1) * 10
        assert whole == abs(round(tons))


@pytest.mark.parametrize("part,whole,expected", [(200, 20, 100.0), (50, 20, 25.0), (5, 0, 0.0), (1, 16, 0.6), (1, 80, 0.1), (1, 8, 1.2)])
def test_percentage(spark, part, whole, expected):
    got = values(spark, [(part, whole)], "p BIGINT, w BIGINT", rounding.percentage("p", "w"))
    assert float(got[0][0]) == expected


def test_display(spark):
    df = spark.createDataFrame([(Decimal("12.3"), True), (Decimal("0.0"), True), (Decimal("0.0"), False)], "v DECIMAL(20,1), k BOOLEAN")
    got = rows(df.select(display.percent(F.col("v"), F.col("k")), display.tons(F.col("v"))))
    assert got == [("0 %", "0 t"), ("0.0 %", "0 t"), ("12.3 %", "12 t")]
