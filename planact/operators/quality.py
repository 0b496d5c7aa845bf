"""Checks before a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.functions import cleaning
from planact.functions import materials as mat


class QualityError(ValueError):
    """A load was refused; ``bad_rows`` is the DataFrame of offending rows."""

    def __init__(self, message: str, bad_rows: DataFrame):
        super().__init__(message)
        self.bad_rows = bad_rows


def without_category(materials: DataFrame) -> DataFrame:
    """Rows that stop a material load: category missing or blank."""
    return materials.where(F.col("material_id").isNotNull()).where(cleaning.is_blank(F.col("category")))


def category_summary(materials: DataFrame) -> DataFrame:
    rows = materials.where(F.col("material_id").isNotNull())
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(cleaning.is_blank(F.col("category"))).alias("bad_rows"),
    )


def require_categories(materials: DataFrame) -> None:
    """Raise if any category is missing. One aggregate of one row reaches the driver."""
    bad = category_summary(materials).first()["bad_rows"]
    if bad:
        raise QualityError(f"{bad} material rows have no category", without_category(materials))


def valid_materials(materials: DataFrame) -> DataFrame:
    return materials.where(mat.is_valid_material_id(F.col("material_id")))


def known_materials(rows: DataFrame, materials: DataFrame) -> DataFrame:
    """Rows whose material is in the dimension."""
    return rows.join(materials.select("material_id").distinct(), "material_id", "left_semi")


def filled_columns(df: DataFrame) -> DataFrame:
    """One row: for each column, how many cells hold a value (all columns in one pass)."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all. One row of counts reaches the driver."""
    counts = filled_columns(df).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])
