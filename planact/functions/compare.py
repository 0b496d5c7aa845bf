"""When does a new number count as a change?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed value --------------------------------------------------------------------
RELATIVE_TOLERANCE = 1e-5
# ------------------------------------------------------------------------------------


def is_close(a: Column, b: Column, tolerance: float = RELATIVE_TOLERANCE) -> Column:
    a, b = a.cast("double"), b.cast("double")
    return F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))


def value_changed(stored: Column, new: Column) -> Column:
    """Null and 0 count as the same; otherwise one missing side is a change."""
    both_empty = (F.coalesce(stored, F.lit(0)) == 0) & (F.coalesce(new, F.lit(0)) == 0)
    one_missing = stored.isNull() | new.isNull()
    return F.when(both_empty, False).when(one_missing, True).otherwise(~is_close(stored, new))
