"""What the physical plans look like: pruning, pushdown, no products, skew."""

import re

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from planact import schemas
from planact.operators import actuals, dedupe, plan
from planact.plans import category_sums, daily_report, material_report
from planact.sinks import tables as sink
from planact.sources import star_views as sv

SF = "/root/testdata/sf0.001"
MONTH = ("1998-01-01", "1998-01-31")


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "200")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark):
    return sv.inputs(spark, SF)


def reports(data):
    return {
        "daily": daily_report.daily_report(data, *MONTH, "V0"),
        "history": daily_report.daily_history(data),
        "sums": category_sums.category_sums(data, *MONTH, "V0"),
        "materials": material_report.material_report(data, *MONTH, "V0"),
    }


def test_no_products(data):
    for name, df in reports(data).items():
        text = plan_of(df)
        assert "CartesianProduct" not in text, name
        assert not re.search(r"BroadcastNestedLoopJoin", text), name


def test_movement_scan_is_pruned_and_filtered(data):
    text = plan_of(actuals.daily_measures(actuals.day_material_mass(data.movements, *MONTH), data.materials))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in scan and "LessThan(l_shipdate,1998-02-01" in scan
    read = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"
    }


def test_one_scan_of_the_movements_feeds_all_measures(data):
    text = plan_of(actuals.daily_measures(actuals.day_material_mass(data.movements), data.materials))
    assert text.count("lineitem.parquet") == 1
    assert text.count("partial_sum") >= 2


def test_no_window_and_no_python(data):
    for df in reports(data).values():
        text = plan_of(df)
        assert "Window" not in text and "Python" not in text


def test_number_of_scans_does_not_grow_with_days(data):
    short = plan_of(daily_report.daily_report(data, "1998-01-01", "1998-01-02", "V0"))
    long = plan_of(daily_report.daily_report(data, *MONTH, "V0"))
    assert short.count("FileScan") == long.count("FileScan")


def test_stored_movements_are_read_by_partition(spark, data, tmp_path):
    """A report reads the months of its interval, an append the months of its batch."""
    path = str(tmp_path / "t")
    sink.append_by_month(data.movements, "day", path)
    stored = spark.read.parquet(path)
    text = plan_of(actuals.daily_total(stored, *MONTH))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", scan).group(1)
    assert "part_month" in filters and "1998-01-01" in filters
    assert rows(actuals.daily_total(stored, *MONTH)) == rows(actuals.daily_total(data.movements, *MONTH))
    batch = data.movements.limit(5)
    text = plan_of(dedupe.new_movements(batch, stored, schemas.PART_MONTH))
    assert "dynamicpruning" in text
    assert dedupe.new_movements(batch, stored, schemas.PART_MONTH).isEmpty()


def test_plan_is_read_by_version(spark, data, tmp_path):
    path = str(tmp_path / "p")
    sink.append_plan(data.plan.drop("inserted_at"), path)
    stored = spark.read.schema(schemas.PLAN_FACT).parquet(path)
    text = plan_of(plan.allocate_months(stored, data.shutdown, data.materials, version="V0", month="1998-01-01"))
    scan = next(line for line in text.splitlines() if "FileScan" in line and path in line)
    assert "version" in re.search(r"PartitionFilters: \[(.*?)\], Pushed", scan).group(1)
    assert "EqualTo(month,1998-01-01)" in scan
    kept = ("version", "material_id", "month", "budget", "forecast")
    assert rows(plan.monthly_plan(stored), *kept) == rows(plan.monthly_plan(data.plan), *kept)


def test_hot_document_is_split(spark):
    """A third of the new rows carry one key; adaptive execution splits its partition."""
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id").cast("string")))
    pad = F.sha2(F.col("id").cast("string"), 512)

    def docs(n):
        return spark.range(0, n, 1, 12).select(
            hot.alias("doc_id"), F.lit("M").alias("material_id"), pad.alias("label"),
            F.lit("2025-01-01").cast("date").alias("day"), F.lit("ROH").alias("cls"), F.lit(55).alias("place"),
            F.lit(1.0).alias("kg"),
        )

    stored = spark.createDataFrame([("d1", "M", "L", day("2025-01-01"), "ROH", 55, 1.0)], schemas.MOVEMENT)
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        out = dedupe.new_movements(docs(60_000), stored)
        out.write.format("noop").mode("overwrite").save()
        counted = out.groupBy("doc_id").count().where("doc_id = 'hot'")
        assert rows(counted) == [("hot", 20_000)]
        got = out.select("doc_id", "label")
        got.collect()
        assert "skew=true" in plan_of(got)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_material_is_reduced_before_the_shuffle(spark, make):
    """One material with most rows: each task sends one row per day and material."""
    moves = spark.range(0, 40_000, 1, 8).select(
        F.lit("d").alias("doc_id"), F.lit("M1").alias("material_id"), F.lit("L").alias("label"),
        F.lit("2025-01-05").cast("date").alias("day"), F.lit("ROH").alias("cls"), F.lit(55).alias("place"),
        F.lit(-1.0).alias("kg"),
    )
    mass = actuals.day_material_mass(moves)
    assert rows(mass, "raw_main_mg") == [(-40_000_000_000,)]
    text = plan_of(mass)
    assert text.index("partial_sum") > text.index("Exchange")


def test_plan_side_reads_the_months_of_the_report(spark):
    data = sv.inputs(spark, SF, MONTH, "V0")
    for name, df in reports(data).items():
        if name != "history":
            scans = [line for line in plan_of(df).splitlines() if "orders.parquet" in line]
            assert scans and all("GreaterThanOrEqual(o_orderdate,1998-01-01" in x and "LessThan(o_orderdate,1998-02-01" in x for x in scans), name
