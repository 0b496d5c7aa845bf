"""Actual consumption from stock movements.

Every measure of the day starts from one aggregate, :func:`day_material_mass`: a single
scan, filtered to the slices anyone asks for and summed per (day, material) with partial
aggregation on the map side, so a material that holds a third of all movements reaches
the shuffle as one row per task and day. Percentages, category totals, fluxes and
recirculates are all derived from that much smaller frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planact.functions import materials as mat
from planact.functions import rounding as r
from planact.operators import calendar as cal

# --- fixed values: storage places and material classes of the slices ----------------
PLACE_MAIN = 55
PLACE_SIDE = 53
CLASS_RAW = "ROH"
CLASS_RECIRCULATE = "KRSM"
CLASS_FLUX = "HIBE"
# --------------------------------------------------------------------------------------

PLACES = (PLACE_SIDE, PLACE_MAIN)


def main_place() -> Column:
    return F.col("place") == PLACE_MAIN


def both_places() -> Column:
    return F.col("place").isin(*PLACES)


def in_class(name: str) -> Column:
    return mat.same_text(F.col("cls"), name)


def slice_conditions() -> dict[str, Column]:
    """The four movement slices the measures are made of."""
    return {
        "raw_main": in_class(CLASS_RAW) & main_place(),
        "raw": in_class(CLASS_RAW) & both_places(),
        "recirculate": in_class(CLASS_RECIRCULATE) & main_place(),
        "flux": in_class(CLASS_FLUX) & both_places(),
    }


def day_material_mass(
    movements: DataFrame, start: cal.DateLike | None = None, end: cal.DateLike | None = None
) -> DataFrame:
    """(day, material_id) with the milligrams of each slice; null where a slice had no row."""
    rows = (
        cal.in_interval(movements, start, end)
        .where(both_places())
        .select("day", "material_id", "place", "kg", mat.fold(F.col("cls")).alias("kind"))
    )
    kind = F.col("kind")
    wanted = kind.isin(CLASS_RAW, CLASS_FLUX) | ((kind == CLASS_RECIRCULATE) & main_place())
    conditions = {
        "raw_main": (kind == CLASS_RAW) & main_place(),
        "raw": kind == CLASS_RAW,
        "recirculate": kind == CLASS_RECIRCULATE,
        "flux": kind == CLASS_FLUX,
    }
    mg = r.milligrams("kg")
    return (
        rows.where(wanted)
        .groupBy("day", "material_id")
        .agg(*[F.sum(F.when(cond, mg)).alias(f"{name}_mg") for name, cond in conditions.items()])
    )


def fill_days(
    daily: DataFrame,
    start: cal.DateLike | None,
    end: cal.DateLike | None,
    keys: Sequence[str] = ("day",),
    default: int = 0,
) -> DataFrame:
    """Give every day of a closed interval a row, with zeros where nothing moved."""
    if start is None or end is None:
        return daily
    numbers = [c for c in daily.columns if c not in keys]
    filled = cal.days(daily.sparkSession, start, end).join(daily, "day", "left")
    return filled.select(*keys, *[F.coalesce(F.col(c), F.lit(default)).alias(c) for c in numbers])


def daily_total(
    movements: DataFrame, start: cal.DateLike | None = None, end: cal.DateLike | None = None
) -> DataFrame:
    """Whole tons of raw material per day from the main place."""
    per_day = (
        cal.in_interval(movements, start, end)
        .where(main_place() & in_class(CLASS_RAW))
        .groupBy("day")
        .agg(F.sum(r.milligrams("kg")).alias("mg"))
        .select("day", r.abs_whole_tons("coalesce(mg, 0L)").alias("tons"))
    )
    return fill_days(per_day, start, end)


# --- one-day summary --------------------------------------------------------------------


def movement_summary(movements: DataFrame, day: cal.DateLike | None = None) -> DataFrame:
    """Tons per (day, material, label); each movement is rounded to 0.1 t before summing."""
    rows = (
        cal.in_interval(movements, day, day)
        .where(main_place() & in_class(CLASS_RAW))
        .dropna(subset=["material_id", "label", "kg"])
    )
    return (
        rows.groupBy("day", "material_id", "label")
        .agg(F.sum(r.signed_tenth_tons_of_kg("kg")).alias("tenths"))
        .select("day", "material_id", "label", r.tenths_to_decimal("tenths").alias("tons"))
    )


def movement_summary_total(movements: DataFrame, day: cal.DateLike | None = None) -> DataFrame:
    """Overall tons per day of the same rounded movements."""
    return movement_summary(movements, day).groupBy("day").agg(
        F.sum("tons").cast("decimal(20,1)").alias("tons")
    )


# --- material selections ------------------------------------------------------------------


@dataclass(frozen=True)
class Selection:
    """Which materials count: any given part must match, type and category ignore case."""

    material_type: str | None = None
    categories: tuple[str, ...] | None = None
    material_name: str | None = None

    def condition(self) -> Column:
        cond = F.lit(True)
        if self.material_type:
            cond = cond & mat.same_text(F.col("material_type"), self.material_type)
        if self.categories:
            cond = cond & mat.any_text(F.col("category"), self.categories)
        if self.material_name:
            cond = cond & mat.same_text(F.col("material_name"), self.material_name)
        return cond


def select_materials(materials: DataFrame, selection: Selection) -> DataFrame:
    return materials.where(selection.condition())


# --- fixed values: the named selections of the daily figures --------------------------------
SELECTIONS = {
    "all_materials": Selection(),
    "concentrates": Selection(mat.TYPE_CONCENTRATE),
    "concentrates_h": Selection(mat.TYPE_CONCENTRATE, ("H",)),
    "concentrates_n": Selection(mat.TYPE_CONCENTRATE, ("N",)),
    "concentrates_pk": Selection(mat.TYPE_CONCENTRATE, ("PK",)),
    "pastes": Selection(mat.TYPE_PASTE),
    "pastes_p": Selection(mat.TYPE_PASTE, ("P",)),
    "others": Selection(mat.TYPE_OTHERS),
    "others_ri": Selection(mat.TYPE_OTHERS, ("RI",)),
    "others_re": Selection(mat.TYPE_OTHERS, ("RE",)),
    "others_ox": Selection(mat.TYPE_OTHERS, ("Ox",)),
    "other_secondary": Selection(None, ("OX", "P")),
}
# --------------------------------------------------------------------------------------------


def material_days(mass: DataFrame, materials: DataFrame, selection: Selection | None = None) -> DataFrame:
    """Rounded raw-material tenths of known materials on the days they moved."""
    chosen = select_materials(materials, selection or Selection())
    return (
        mass.where(F.col("raw_mg").isNotNull())
        .join(chosen.select("material_id", "material_name", "material_type", "category"), "material_id")
        .select(
            "day",
            "material_id",
            "material_name",
            "material_type",
            "category",
            r.abs_tenth_tons("raw_mg").alias("tenths"),
        )
    )


def daily_by_material(
    movements: DataFrame,
    materials: DataFrame,
    selection: Selection,
    start: cal.DateLike,
    end: cal.DateLike,
) -> DataFrame:
    """Every selected material on every day of the interval, 0 where it did not move."""
    mass = day_material_mass(movements, start, end)
    return _dense(mass, select_materials(materials, selection), r.abs_tenth_tons, "raw_mg", start, end)


def signed_by_material(
    movements: DataFrame, materials: DataFrame, start: cal.DateLike, end: cal.DateLike
) -> DataFrame:
    """As :func:`daily_by_material` for all materials, main place only, sign kept."""
    mass = day_material_mass(movements, start, end)
    return _dense(mass, materials, r.signed_tenth_tons, "raw_main_mg", start, end)


def _dense(mass: DataFrame, materials: DataFrame, rounding, column: str, start, end) -> DataFrame:
    """Join on the material alone, then open up the days.

    The moved days of a material travel as one map of at most (days of the interval)
    entries, so the materials are shuffled once per material instead of once per day.
    """
    moved = moved_days(mass, rounding(column), column)
    rows = materials.select("material_id", "material_name").join(moved, "material_id", "left")
    opened = cal.each_day(rows, cal.date_lit(start), cal.date_lit(end))
    return opened.select(
        "day", "material_id", "material_name", r.tenths_to_decimal(TENTHS_ON_DAY).alias("tons")
    )


def moved_days(mass: DataFrame, value: Column, column: str) -> DataFrame:
    """material_id with a map day -> tenths of the days on which it moved."""
    return (
        mass.where(F.col(column).isNotNull())
        .groupBy("material_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("day", value.alias("tenths")))).alias("by_day"))
    )


# The tenths of the opened-up ``day``, as SQL text.
TENTHS_ON_DAY = "coalesce(try_element_at(by_day, day), 0L)"


def daily_share(
    movements: DataFrame,
    materials: DataFrame,
    selection: Selection,
    start: cal.DateLike | None = None,
    end: cal.DateLike | None = None,
) -> DataFrame:
    """Day total of a selection and its percentage of the day's raw-material total."""
    measured = measures_by_day(
        day_material_mass(movements, start, end), materials, {"part": selection}
    )
    filled = fill_days(measured, start, end)
    return filled.select(
        "day",
        r.tenths_to_decimal("part_tenths").alias("tons"),
        r.percentage("part_tenths", "actual").alias("pct"),
    )


def monthly_totals(daily: DataFrame, value: str = "tons") -> DataFrame:
    """Day totals summed per calendar month, keyed ``yyyy-MM``."""
    month = F.date_format("day", "yyyy-MM")
    return daily.groupBy(month.alias("month")).agg(F.sum(value).alias(value))


def side_stream(
    movements: DataFrame, which: str, start: cal.DateLike | None = None, end: cal.DateLike | None = None
) -> DataFrame:
    """Whole tons per (day, material) of the ``recirculate`` or ``flux`` slice."""
    cond = slice_conditions()[which]
    return (
        cal.in_interval(movements, start, end)
        .where(both_places())
        .where(cond)
        .groupBy("day", "material_id")
        .agg(F.sum(r.milligrams("kg")).alias("mg"))
        .select("day", "material_id", r.abs_whole_tons("coalesce(mg, 0L)").alias("tons"))
    )


def side_stream_daily(
    movements: DataFrame, which: str, start: cal.DateLike | None = None, end: cal.DateLike | None = None
) -> DataFrame:
    per_day = side_stream(movements, which, start, end).groupBy("day").agg(F.sum("tons").alias("tons"))
    return fill_days(per_day, start, end)


# --- all measures at once -------------------------------------------------------------------


def measures_by_day(mass: DataFrame, materials: DataFrame, selections: dict[str, Selection]) -> DataFrame:
    """From (day, material) to one row per day.

    ``actual``       whole tons of raw material at the main place, unknown materials included
    ``<name>_tenths`` day total of each selection over materials rounded one by one
    ``recirculates``, ``fluxes`` whole tons over materials rounded one by one
    """
    flags = {name: sel.condition() for name, sel in selections.items()}
    known = materials.select(
        "material_id", *[F.coalesce(cond, F.lit(False)).alias(f"is_{name}") for name, cond in flags.items()]
    )
    tenths = r.abs_tenth_tons("raw_mg")
    parts = [
        F.coalesce(F.sum(F.when(F.col(f"is_{name}"), tenths)), F.lit(0)).alias(f"{name}_tenths")
        for name in selections
    ]
    return (
        mass.join(known, "material_id", "left")
        .groupBy("day")
        .agg(
            F.coalesce(F.sum("raw_main_mg"), F.lit(0)).alias("raw_main_mg"),
            *parts,
            F.coalesce(F.sum(r.abs_whole_tons("recirculate_mg")), F.lit(0)).alias("recirculates"),
            F.coalesce(F.sum(r.abs_whole_tons("flux_mg")), F.lit(0)).alias("fluxes"),
        )
        .withColumn("actual", r.abs_whole_tons("raw_main_mg"))
        .drop("raw_main_mg")
    )


# --- fixed values: the percentages of the daily report -----------------------------------------
DAILY_SHARES = {
    "main": SELECTIONS["concentrates_h"],
    "side": SELECTIONS["concentrates_n"],
    "intern": SELECTIONS["others_ri"],
    "extern": SELECTIONS["others_re"],
    "other_secondary": SELECTIONS["other_secondary"],
}
# -----------------------------------------------------------------------------------------------


def daily_measures(
    mass: DataFrame,
    materials: DataFrame,
    start: cal.DateLike | None = None,
    end: cal.DateLike | None = None,
) -> DataFrame:
    """The actual side of the daily report: one scan, two aggregations, one dimension join."""
    measured = fill_days(measures_by_day(mass, materials, DAILY_SHARES), start, end)
    return measured.select(
        "day",
        "actual",
        *[r.percentage(f"{name}_tenths", "actual").alias(f"{name}_pct") for name in DAILY_SHARES],
        "recirculates",
        "fluxes",
    )
