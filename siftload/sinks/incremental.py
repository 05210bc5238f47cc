"""Loads of what is new in a source, by a high-water mark that is kept with the target.

A mark is the largest value of a time or number column that the loads so far have read. It is noted with the load
itself: a job that stops between reading and committing leaves the old mark, and the next one reads the same rows again.
The new rows are staged, so the mark and the load come from one reading of the source; the cut stands in the plan as a
constant that reaches the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.sinks.target import ParquetTarget
from siftload.sources.staging import staged

Build = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _mark(source: DataFrame, column: str, mark: str | None) -> Column:
    return F.lit(mark).cast(source.schema[column].dataType)


def rows_since(source: DataFrame, column: str, mark: str | None, overlap: timedelta | int) -> DataFrame:
    """Rows from ``overlap`` before the mark on, and those without a value, which no mark can tell apart. All without a mark."""
    if mark is None:
        return source
    return source.where((F.col(column) >= _mark(source, column, mark) - F.lit(overlap)) | F.col(column).isNull())


def rows_after(source: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows beyond the mark; rows without a value never are. All rows with a value without a mark."""
    if mark is None:
        return source.where(F.col(column).isNotNull())
    return source.where(F.col(column) > _mark(source, column, mark))


def taken(rows: DataFrame, column: str, mark: str | None) -> tuple[DataFrame, str | None]:
    """``rows``, staged, and the next mark: their largest value, or the old mark if that is larger."""
    held = staged(rows)
    largest = F.greatest(F.max(column), _mark(rows, column, mark)) if mark is not None else F.max(column)
    return held, held.agg(largest.cast("string")).first()[0]


def upsert_increment(
    target: ParquetTarget, name: str, source: DataFrame, column: str, overlap: timedelta | int, keys: list[str], build: Build = _as_is, **how
) -> int:
    """Upserts what ``build`` makes of the rows of ``source`` since the mark ``name``, less ``overlap``; returns the rows loaded.

    ``column`` says when a row was last changed. Rows that come late are taken while they are within the overlap. A key
    taken again is updated in place, so the overlap and a repeated load change nothing. A row that was removed from the
    source stays in the target.
    """
    mark = target.marks().get(name)
    rows, reached = taken(rows_since(source, column, mark, overlap), column, mark)
    return target.merge(build(rows), keys, marks={name: reached}, **how)


def append_increment(target: ParquetTarget, name: str, source: DataFrame, column: str, build: Build = _as_is) -> None:
    """Appends what ``build`` makes of the rows of ``source`` beyond the mark ``name`` to a target with load ids.

    The load's id is the mark it starts from. So a load that stopped after its write and before its commit is replaced by
    the next one, which starts from the same mark, also if that finds more rows. Rows that come late, at or below the mark, are
    not taken; where there are such, upsert.
    """
    mark = target.marks().get(name)
    rows, reached = taken(rows_after(source, column, mark), column, mark)
    target.append(build(rows), load_id=f"{name} after {mark}", marks={name: reached})
