"""Plan workbook sheets, landed as CSV (one folder or file per sheet).

Spark has no spreadsheet reader; the contract is one CSV per sheet with the cells as text.
Row order inside a sheet matters for two things (the version cell is the first data cell,
the last row of an id wins), so each row carries ``row_order``: the offset of the file block
it came from and its position in it, which together follow the order of the file however it
is split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planact.functions import cleaning, dates
from planact.functions import materials as mat
from planact.operators import dedupe, quality
from planact.operators.plan import BUDGET, FORECAST

# --- fixed values: positions in the sheets --------------------------------------------------
PLAN_LEADING = ("material_name", "material_id", "dummy", "category")
SHUTDOWN_DATE_POSITION = 0
SHUTDOWN_HOURS_POSITION = 4
CATALOGUE_COLUMNS = ("material_id", "material_name", "material_type", "category")
# --------------------------------------------------------------------------------------------

ROW_ORDER = "row_order"


def _row_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )


def read_plan_grid(spark: SparkSession, path: str) -> DataFrame:
    """A plan sheet: four leading columns by position, then every other column by its header.

    Only the header line is read to find the names; all cells stay text.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    headers = raw.columns
    named = raw.select(
        *[F.col(f"`{h}`").alias(n) for h, n in zip(headers, PLAN_LEADING)],
        *[F.col(f"`{h}`").alias(cleaning.clean_header(h)) for h in headers[len(PLAN_LEADING):]],
        _row_order().alias(ROW_ORDER),
    )
    return named.drop("dummy")


def version_of(forecast_grid: DataFrame) -> DataFrame:
    """One row, one column: the first data cell of the forecast sheet names the version."""
    return forecast_grid.agg(F.min_by("material_name", ROW_ORDER).alias("version"))


def month_headers(columns: Sequence[str], years: Sequence[int] | None = None) -> dict[str, dt.date]:
    """Headers that name a month, with that month; of the wanted years, if the caller names some."""
    found = {c: dates.header_month(c) for c in columns}
    return {c: m for c, m in found.items() if m is not None and (years is None or m.year in years)}


def months_left_out(columns: Sequence[str], years: Sequence[int] | None) -> list[str]:
    """Headers that name a month of another year: what a list of years keeps out of a load."""
    return [c for c in month_headers(columns) if c not in month_headers(columns, years)]


def plan_rows(
    grid: DataFrame, measure: str, version: Column, years: Sequence[int] | None = None
) -> DataFrame:
    """A plan sheet as rows (version, material_id, month, measure, value); bad ids dropped.

    Only the month columns of the wanted years are read. Empty cells stay null here (the
    change check tells null from a number); a load writes them as 0.
    """
    months = month_headers(grid.columns, years)
    cells = [
        F.struct(F.lit(m).alias("month"), F.trim(F.col(f"`{c}`")).try_cast("decimal(18,2)").alias("value"))
        for c, m in months.items()
    ]
    valid = quality.valid_materials(grid)
    return valid.select("material_id", F.inline(F.array(*cells))).select(
        version.alias("version"), "material_id", "month", F.lit(measure).alias("measure"), "value"
    )


def material_rows(grid: DataFrame) -> DataFrame:
    """The material dimension in a plan sheet: valid ids, typed by their prefix, last row wins."""
    valid = quality.valid_materials(grid).withColumn(
        "material_type", mat.material_type_of(F.col("material_id"))
    )
    rows = valid.select("material_id", "material_name", "material_type", "category", ROW_ORDER)
    return dedupe.last_row_wins(rows, ["material_id"], ROW_ORDER).drop(ROW_ORDER)


def read_shutdown_grid(
    spark: SparkSession,
    path: str,
    measure: str,
    version: Column,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """A shutdown sheet: date and hours by position; rows without a date (the headers too) drop out."""
    width = max(SHUTDOWN_DATE_POSITION, SHUTDOWN_HOURS_POSITION) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)
    day = dates.parse_date(F.col(f"c{SHUTDOWN_DATE_POSITION}"))
    return (
        raw.select(
            version.alias("version"),
            day.alias("day"),
            F.lit(measure).alias("measure"),
            cleaning.hours_or_zero(F.col(f"c{SHUTDOWN_HOURS_POSITION}")).alias("hours"),
        )
        .where(F.col("day").isNotNull())
        .where(dates.in_years(F.col("day"), None if years is None else list(years)))
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The second material catalogue: ids shortened, missing categories made empty."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CATALOGUE_COLUMNS])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return raw.select(
        mat.normalize_material_id(F.col("material_id")).alias("material_id"),
        "material_name",
        "material_type",
        cleaning.blank_to_empty(F.col("category")).alias("category"),
    )


def read_workbook(
    spark: SparkSession,
    budget: str,
    forecast: str,
    budget_shutdown: str,
    forecast_shutdown: str,
    years: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    """All sheets of one plan workbook as ``materials``, ``plan`` and ``shutdown``."""
    budget_grid = read_plan_grid(spark, budget)
    forecast_grid = read_plan_grid(spark, forecast)
    version = version_of(forecast_grid).scalar()
    return {
        "materials": material_rows(budget_grid),
        "budget": plan_rows(budget_grid, BUDGET, version, years),
        "forecast": plan_rows(forecast_grid, FORECAST, version, years),
        "budget_shutdown": read_shutdown_grid(spark, budget_shutdown, BUDGET, version, years),
        "forecast_shutdown": read_shutdown_grid(spark, forecast_shutdown, FORECAST, version, years),
    }
