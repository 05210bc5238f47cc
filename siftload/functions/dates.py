"""Date and time expressions on zone-free timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats, and the summer-time ranges that two of the jobs use, as (from, to, hours to add).
DAY_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
CAMPAIGN_HOUR_SHIFTS = [
    ("2020-03-29", "2020-10-25", 2),
    ("2020-10-25", "2021-03-28", 1),
    ("2021-03-28", "2021-10-31", 2),
]
CONTRACT_HOUR_SHIFTS = [
    ("2017-10-29", "2018-03-25", 1),
    ("2018-03-25", "2018-10-28", 2),
    ("2018-10-28", "2019-03-31", 1),
    ("2019-03-31", "2019-10-27", 2),
    ("2019-10-27", "2020-03-29", 1),
]
DEFAULT_HOUR_SHIFT = 2


def ntz(value: str | date | datetime) -> Column:
    """Zone-free timestamp literal; folded to a constant, so a filter on it reaches the scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def date_to_text(c: Column, fmt: str = DAY_FORMAT) -> Column:
    return F.date_format(c, fmt)


def _interval(amount: int, unit: str) -> Column:
    return F.expr(f"interval {int(amount)} {unit}")


def shift_hours_fixed(c: Column, hours: int = DEFAULT_HOUR_SHIFT) -> Column:
    return c + _interval(hours, "hours")


def shift_hours_by_period(
    c: Column,
    periods: Sequence[tuple[str, str, int]],
    default_hours: int = DEFAULT_HOUR_SHIFT,
) -> Column:
    """Hours of the first period that holds the time, both ends included; the default outside all of them."""
    out = None
    for start, end, hours in periods:
        hit, value = c.between(ntz(start), ntz(end)), shift_hours_fixed(c, hours)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    fallback = shift_hours_fixed(c, default_hours)
    return fallback if out is None else out.otherwise(fallback)


def shift_to_zone(c: Column, zone: str = "Europe/Warsaw") -> Column:
    """UTC time to the wall clock of a zone by the zone's own rules."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def add_days(c: Column, days: int = 1) -> Column:
    return c + _interval(days, "days")


def days_before(as_of: Column | str | datetime, days: int) -> Column:
    anchor = as_of if isinstance(as_of, Column) else ntz(as_of)
    return anchor - _interval(days, "days")


def to_day(c: Column) -> Column:
    return c.cast("date")


def year_of(c: Column) -> Column:
    return F.year(c)


def from_year(c: Column, year: int) -> Column:
    """``year(c) >= year`` as a range on the bare column, so that it is pushed to the scan."""
    return c >= ntz(f"{year:04d}-01-01")


def parse_timestamp(c: Column, fmt: str = SECOND_FORMAT) -> Column:
    """Null where the text does not fit."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
