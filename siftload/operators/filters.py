"""Predicates that need more than a plain comparison."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftload.functions.dates import days_before


def or_null(condition: Column, c: Column) -> Column:
    """Keeps rows the left join did not match as well."""
    return condition | c.isNull()


def any_not_null(*columns: Column) -> Column:
    out = columns[0].isNotNull()
    for c in columns[1:]:
        out = out | c.isNotNull()
    return out


def within_days(c: Column, as_of: Column | str | datetime, days: int) -> Column:
    """Newer than ``days`` before ``as_of``. The moment is passed in, so a rerun gives the same rows."""
    return c >= days_before(as_of, days)


def equals_text_number(c: Column, text: str, to: str = "int") -> Column:
    """A number column against a number written as text: the literal is cast, the column stays bare."""
    return c == F.lit(text).cast(to)


def listed_or(condition: Column, c: Column, listed: Sequence[object]) -> Column:
    return condition | c.isin(*listed) if listed else condition
