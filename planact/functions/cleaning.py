"""Defaults and casts for dirty text feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: what stands in for a missing or bad cell -------------------------
TEXT_DEFAULT = " "
INT_DEFAULT = -1
DATE_DEFAULT = "1970-01-01"
FLOAT_DEFAULT = 0.0
FLOAT_DIGITS = 6
GERMAN_DATE = r"^\d{1,2}\.\d{1,2}\.\d{4}"
FLOAT_LIMIT = 1.79e308
MASS_LIMIT = 1e9
# ------------------------------------------------------------------------------------


def text_or_default(c: Column) -> Column:
    return F.coalesce(c, F.lit(TEXT_DEFAULT))


def int_or_default(c: Column) -> Column:
    """Whole part of a number in text form; anything else gives the default."""
    number = F.trim(c).try_cast("double")
    whole = F.when(~F.isnan(number), number).try_cast("int")
    return F.coalesce(whole, F.lit(INT_DEFAULT))


def parsed_date(c: Column) -> Column:
    """ISO dates (with or without a time) by cast; the German form only where the text has it.

    A failed parse costs an exception per row, so text is looked at before it is parsed.
    """
    text = F.trim(c)
    german = F.when(text.rlike(GERMAN_DATE), F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("d.M.yyyy"))))
    return F.coalesce(text.try_cast("date"), german)


def date_or_default(c: Column) -> Column:
    return F.coalesce(parsed_date(c), F.lit(DATE_DEFAULT).cast("date"))


def number(c: Column) -> Column:
    """Decimal comma to point and cast; null if the text is no number."""
    return F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")


def _six_digits(value: Column) -> Column:
    # From 2**53 / 10**6 on, about 9e9, neighbouring doubles are more than a millionth apart: there is
    # no sixth digit left to round.
    scale = F.lit(10.0**FLOAT_DIGITS)
    return F.when(F.abs(value) < 2.0**53 / 10.0**FLOAT_DIGITS, F.rint(value * scale) / scale)


def float_or_default(c: Column) -> Column:
    """Decimal comma to point, cast, bound to the double range, six digits."""
    value = number(c)
    # NaN fails every comparison but the last.
    cleaned = (
        F.when(F.abs(value) < 2.0**53 / 10.0**FLOAT_DIGITS, _six_digits(value))
        .when(F.isnan(value), F.lit(FLOAT_DEFAULT))
        .when(value > FLOAT_LIMIT, F.lit(FLOAT_LIMIT))
        .when(value < -FLOAT_LIMIT, F.lit(-FLOAT_LIMIT))
        .otherwise(value)
    )
    return F.coalesce(cleaned, F.lit(FLOAT_DEFAULT))


def mass(c: Column) -> Column:
    """A mass in kg; null if the text is no number or beyond what a posting may hold (not finite, for one)."""
    value = number(c)
    return F.when(F.abs(value) <= MASS_LIMIT, value)


def mass_or_default(c: Column) -> Column:
    """As ``float_or_default``, but what is out of range is a bad cell: one of them would overflow a day's sum."""
    return F.coalesce(_six_digits(mass(c)), F.lit(FLOAT_DEFAULT))


def hours_or_zero(c: Column) -> Column:
    number = F.trim(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def blank_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def clean_header(name: str) -> str:
    """Outer quotes, then outer blanks, off a column name."""
    return name.strip("'").strip()
