"""Material ids and classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
TYPE_CONCENTRATE = "Cons"
TYPE_PASTE = "Paste"
TYPE_OTHERS = "Others"
CATEGORIES = ("H", "N", "PK", "P", "Ox", "RI", "RE")
PLAIN_ID = "^1[0-9]{6}$"
ID_SUFFIXES = "-b|-H1|-H2"
# ----------------------------------------------------------------------------------


def is_valid_material_id(material_id: Column) -> Column:
    """Seven digits starting with 1, or a suffixed id whose stem has seven characters."""
    stem_is_seven = F.length(F.substring_index(material_id, "-", 1)) == 7
    suffixed = material_id.rlike(ID_SUFFIXES) & stem_is_seven
    return F.coalesce(material_id.rlike(PLAIN_ID) | suffixed, F.lit(False))


def material_type_of(material_id: Column) -> Column:
    return (
        F.when(material_id.startswith("11"), TYPE_CONCENTRATE)
        .when(material_id.startswith("121"), TYPE_PASTE)
        .otherwise(TYPE_OTHERS)
    )


def normalize_material_id(material_id: Column, only_leading_one: bool = False) -> Column:
    """Remove the third and fifth character; optionally only for ids starting with 1."""
    short = F.concat(
        F.substring(material_id, 1, 2),
        F.substring(material_id, 4, 1),
        F.substr(material_id, F.lit(6)),
    )
    if only_leading_one:
        return F.when(material_id.startswith("1"), short).otherwise(material_id)
    return short


def fold(text: Column) -> Column:
    """Comparison key for types, categories and classes: case and outer blanks ignored."""
    return F.upper(F.trim(text))


def same_text(column: Column, value: str) -> Column:
    return fold(column) == F.lit(value.strip().upper())


def any_text(column: Column, values: list[str] | tuple[str, ...]) -> Column:
    return fold(column).isin(*[v.strip().upper() for v in values])
