"""The domain tables, derived from the star-schema test tables.

Amounts are summed as whole cents in long arithmetic and turned into DECIMAL at the end.
Filters put on the derived ``day`` reach the Parquet scan: the optimizer unwraps the date
cast into a range on the stored timestamp.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planact.operators import calendar as cal
from planact.operators.plan import BUDGET, FORECAST
from planact.plans.inputs import Inputs

# --- fixed values: how the test tables are read as the domain ---------------------------------
KG_PER_UNIT = 137
TELEMETRY_YEARS_BACK = 26
HOURS_PER_EVENT = 4
REPORT_MONTH = "1998-01-01"
LOADED = {"V0": "2024-01-01 00:00:00", "V1": "2024-02-01 00:00:00", "V2": "2024-03-01 00:00:00"}
# ----------------------------------------------------------------------------------------------


# First and last day of the months wanted, or None for all.
Months = tuple[str, str] | None


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_KEY, _INT, _TEXT, _REAL, _AT = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()

# Given up front, so that building a query reads no file footer.
SCHEMAS = {
    "part": _schema(
        p_partkey=_KEY, p_name=_TEXT, p_brand=_TEXT, p_type=_TEXT, p_size=_INT, p_retailprice=_REAL
    ),
    "supplier": _schema(s_suppkey=_KEY, s_name=_TEXT, s_nationkey=_INT, s_acctbal=_REAL),
    "orders": _schema(
        o_orderkey=_KEY, o_custkey=_KEY, o_orderstatus=_TEXT, o_totalprice=_REAL, o_orderdate=_AT, o_orderpriority=_TEXT
    ),
    "lineitem": _schema(
        l_orderkey=_KEY, l_partkey=_KEY, l_suppkey=_KEY, l_linenumber=_INT, l_quantity=_REAL, l_extendedprice=_REAL,
        l_discount=_REAL, l_tax=_REAL, l_returnflag=_TEXT, l_linestatus=_TEXT, l_shipdate=_AT,
    ),
    "events": _schema(event_id=_KEY, ts=_AT, user_id=_KEY, event_type=_TEXT, value=_REAL, props=_TEXT),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    kind = (
        F.when(F.col("p_type").isin("ECONOMY", "STANDARD", "SMALL"), "Cons")
        .when(F.col("p_type") == "MEDIUM", "Paste")
        .otherwise("Others")
    )

    def by_size(zero: str, one: str, two: str):
        rest = F.col("p_size") % 3
        return F.when(rest == 0, zero).when(rest == 1, one).otherwise(two)

    category = (
        F.when(kind == "Cons", by_size("H", "N", "PK"))
        .when(kind == "Paste", F.lit("P"))
        .otherwise(by_size("Ox", "RI", "RE"))
    )
    return part.select(
        F.col("p_partkey").cast("string").alias("material_id"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("material_name"),
        kind.alias("material_type"),
        category.alias("category"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, supplier = F.col("l_returnflag"), F.col("l_suppkey") % 3
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("doc_id"),
        F.col("l_partkey").cast("string").alias("material_id"),
        F.concat(F.lit("M"), F.col("l_partkey").cast("string")).alias("label"),
        F.to_date("l_shipdate").alias("day"),
        F.when(flag == "R", "ROH").when(flag == "A", "KRSM").otherwise("HIBE").alias("cls"),
        F.when(supplier == 0, 55).when(supplier == 1, 53).otherwise(51).alias("place"),
        (-F.col("l_quantity") * KG_PER_UNIT).alias("kg"),
    )


def _version(rest: str):
    return F.concat(F.lit("V"), F.col(rest).cast("string"))


def _loaded(version):
    chain = F
    for name, stamp in LOADED.items():
        chain = chain.when(version == name, F.lit(stamp).cast("timestamp_ntz"))
    return chain


def _orders(spark: SparkSession, sf_dir: str, months: Months = None, version: str | None = None) -> DataFrame:
    """Orders of some months and one version; both conditions stand on stored columns and reach the scan."""
    orders = table(spark, sf_dir, "orders")
    if months is not None:
        first, last = (cal.as_date(x) for x in months)
        until = cal.end_of_month(last) + dt.timedelta(days=1)
        at = [F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (first.replace(day=1), until)]
        orders = orders.where((F.col("o_orderdate") >= at[0]) & (F.col("o_orderdate") < at[1]))
    if version is not None:
        orders = orders.where(F.col("o_orderkey") % 3 == int(version.removeprefix("V")))
    return orders


def plan_wide(spark: SparkSession, sf_dir: str, months: Months = None, version: str | None = None) -> DataFrame:
    """Budget and forecast per version, material and month.

    Grouped on whole numbers and dates; the texts are made from the groups.
    """
    orders = _orders(spark, sf_dir, months, version).select(
        "o_orderkey", (F.col("o_orderkey") % 3).alias("rest"), F.to_date(F.trunc("o_orderdate", "MM")).alias("month")
    )
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    kept = F.rint((1 - F.col("l_discount")) * 100).cast("bigint")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", cents.alias("cents"), (cents * kept).alias("kept"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("rest", "l_partkey", "month")
        .agg(F.sum("cents").alias("b"), F.sum("kept").alias("f"))
        .select(
            _version("rest").alias("version"),
            F.col("l_partkey").cast("string").alias("material_id"),
            "month",
            F.expr("CAST(CAST(b AS DECIMAL(19,0)) * 0.01BD AS DECIMAL(18,2))").alias(BUDGET),
            F.expr("CAST(CAST(f AS DECIMAL(19,0)) * 0.0001BD AS DECIMAL(18,2))").alias(FORECAST),
        )
    )


def plan(spark: SparkSession, sf_dir: str, months: Months = None, version: str | None = None) -> DataFrame:
    """The plan as a long fact table, each version with the time it was loaded."""
    wide = plan_wide(spark, sf_dir, months, version)
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in (BUDGET, FORECAST)])
    return wide.select("version", "material_id", "month", F.inline(pairs)).withColumn(
        "inserted_at", _loaded(F.col("version"))
    )


def shutdown(spark: SparkSession, sf_dir: str, months: Months = None, version: str | None = None) -> DataFrame:
    """Shutdown hours per version and day, long."""

    def hours(status: str, name: str):
        return F.least(
            F.sum(F.when(F.col("o_orderstatus") == status, 1).otherwise(0)) * HOURS_PER_EVENT, F.lit(24)
        ).alias(name)

    wide = (
        _orders(spark, sf_dir, months, version)
        .groupBy((F.col("o_orderkey") % 3).alias("rest"), F.to_date("o_orderdate").alias("day"))
        .agg(hours("F", BUDGET), hours("P", FORECAST))
        .withColumn("version", _version("rest"))
    )
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("hours")) for m in (BUDGET, FORECAST)]
    )
    return wide.select("version", "day", F.inline(pairs)).withColumn("inserted_at", _loaded(F.col("version")))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sensor rows, moved back so that they meet the movements."""
    value = F.col("value").cast("decimal(10,2)")

    def only(kind: str):
        return F.when(F.col("event_type") == kind, value)

    return table(spark, sf_dir, "events").select(
        (F.col("ts") - F.expr(f"INTERVAL '{TELEMETRY_YEARS_BACK}' YEAR")).alias("ts"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).cast("decimal(10,2)").alias("run_flag"),
        value.alias("feed"),
        only("purchase").alias("coal"),
        only("click").alias("dust_set"),
        F.lit(None).cast("decimal(10,2)").alias("humidity"),
        only("view").alias("dust_out"),
        only("signup").alias("slag"),
    )


def inputs(spark: SparkSession, sf_dir: str, months: Months = None, version: str | None = None) -> Inputs:
    """All tables; the plan side of some months and one version only, as a report asks for."""
    return Inputs(
        materials(spark, sf_dir),
        movements(spark, sf_dir),
        plan(spark, sf_dir, months, version),
        shutdown(spark, sf_dir, months, version),
        telemetry(spark, sf_dir),
    )
