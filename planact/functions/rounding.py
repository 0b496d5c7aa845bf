"""Half-even rounding without binary floating point.

Masses are carried as whole milligrams in BIGINT: sums are exact, do not depend on
the order of rows, and stay in long arithmetic inside generated code. Rounding is
done on integers (quotient and remainder), so a tie is a tie.

The integer formulas are written as SQL text over column names or expressions, so that
each reaches the JVM in one call however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MG_PER_KG = 1_000_000
MG_PER_TON = 1_000 * MG_PER_KG
MG_PER_TENTH_TON = MG_PER_TON // 10


def _half_even(n: str, d: str) -> str:
    twice_rest = f"2 * (({n}) % ({d}))"
    odd = f"(({n}) div ({d})) % 2 = 1"
    return f"(({n}) div ({d}) + CASE WHEN {twice_rest} > ({d}) OR ({twice_rest} = ({d}) AND {odd}) THEN 1L ELSE 0L END)"


def _milligrams(kg: str) -> str:
    return f"CAST(rint(CAST({kg} AS DOUBLE) * {MG_PER_KG}D) AS BIGINT)"


def milligrams(kg: str) -> Column:
    """kg (DOUBLE or DECIMAL, at most 6 digits after the point) as whole milligrams."""
    return F.expr(_milligrams(kg))


def half_even_quotient(numerator: str, denominator: str) -> Column:
    """``numerator / denominator`` rounded half-even to a whole BIGINT.

    Both are SQL text; both must be non-negative, the denominator positive.
    """
    return F.expr(_half_even(numerator, denominator))


def abs_tenth_tons(mg: str) -> Column:
    """``abs(round(t, 1))`` in tenths of a ton, as BIGINT."""
    return half_even_quotient(f"abs({mg})", f"{MG_PER_TENTH_TON}L")


def signed_tenth_tons(mg: str) -> Column:
    """``round(t, 1)`` in tenths of a ton, sign kept."""
    tenths = _half_even(f"abs({mg})", f"{MG_PER_TENTH_TON}L")
    return F.expr(f"CASE WHEN ({mg}) < 0 THEN -{tenths} ELSE {tenths} END")


def signed_tenth_tons_of_kg(kg: str) -> Column:
    return signed_tenth_tons(_milligrams(kg))


def abs_whole_tons(mg: str) -> Column:
    """``abs(round(t))`` as BIGINT."""
    return half_even_quotient(f"abs({mg})", f"{MG_PER_TON}L")


def tenths_to_decimal(tenths: str) -> Column:
    """BIGINT tenths as DECIMAL(20,1)."""
    return F.expr(f"CAST(CAST({tenths} AS DECIMAL(19,0)) * 0.1BD AS DECIMAL(20,1))")


def percentage_tenths(part_tenths: str, whole: str) -> str:
    """SQL text: share of ``whole`` (whole tons) in tenths of a percent; 0 where ``whole`` is 0."""
    safe = f"greatest({whole}, 1L)"
    return f"(CASE WHEN {whole} > 0 THEN {_half_even(f'({part_tenths}) * 100', safe)} ELSE 0L END)"


def percentage(part_tenths: str, whole: str) -> Column:
    """The same share as DECIMAL(20,1)."""
    return tenths_to_decimal(percentage_tenths(part_tenths, whole))


def half_even(value: Column, digits: int) -> Column:
    """Half-even rounding of a DECIMAL column."""
    return F.bround(value, digits)
