"""Date expressions: parsing, months, production days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: text formats found in the inputs -------------------------------
DAY_FORMAT = "dd.MM.yyyy"
HEADER_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%b.%y")
PRODUCTION_DAY_START_HOUR = 6
# ----------------------------------------------------------------------------------


def parse_date(text: Column, fmt: str = DAY_FORMAT) -> Column:
    """Text to DATE; unparsable text gives null, also under ANSI mode."""
    return F.to_date(F.try_to_timestamp(F.trim(text), F.lit(fmt)))


def header_month(name: str) -> dt.date | None:
    """First day of the month a column header names, or None if it names none.

    Headers are metadata the driver already holds, so they are read here, once per column,
    and enter the plan as literals.
    """
    for fmt in HEADER_FORMATS:
        try:
            return dt.datetime.strptime(name.strip(), fmt).date().replace(day=1)
        except ValueError:
            continue
    return None


def label_month(label: str) -> dt.date:
    """First day of the month named ``jan_25``."""
    return dt.datetime.strptime(label, "%b_%y").date()


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def month_label(day: Column) -> Column:
    """``jan_25`` for a day in January 2025."""
    return F.lower(F.date_format(day, "MMM_yy"))


def month_from_label(label: Column) -> Column:
    """Inverse of :func:`month_label`; years are read as 20yy, anything else gives null."""
    name = F.initcap(F.split_part(label, F.lit("_"), F.lit(1)))
    year = F.split_part(label, F.lit("_"), F.lit(2))
    text = F.concat(F.lit("01 "), name, F.lit(" 20"), year)
    return F.to_date(F.try_to_timestamp(text, F.lit("dd MMM yyyy")))


def in_years(day: Column, years: tuple[int, ...] | list[int] | None) -> Column:
    """Whether the day's year is wanted; without a list every year is."""
    return F.lit(True) if years is None else F.year(day).isin(*years)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """DATE from its parts; the month-level member (day 0) gives null."""
    return F.when(day > 0, F.make_date(year, month, F.greatest(day, F.lit(1))))


def production_day(ts: Column) -> Column:
    """The production day starts at 06:00: earlier hours belong to the day before."""
    return F.to_date(ts - F.expr(f"INTERVAL '{PRODUCTION_DAY_START_HOUR}' HOUR"))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)
