"""Targets outside folders: tables of a table format, and tables of a database. Both load by single statements.

Neither was run here: there is no table format and no database. Tests cover the calls and statements they make.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftload.sinks import merge
from siftload.sinks.target import jdbc_append, jdbc_full_refresh


class Target(Protocol):
    """What a plan needs of the table it loads."""

    def read(self) -> DataFrame: ...
    def append(self, df: DataFrame) -> None: ...
    def full_refresh(self, df: DataFrame) -> None: ...
    def replace_window(self, new_rows: DataFrame, window: Column) -> None: ...
    def merge(self, source: DataFrame, keys: Sequence[str], **how) -> object: ...
    def update(self, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()) -> object: ...
    def refresh_from(self, loaded: Target, columns: Sequence[str]) -> None: ...


def folded_source(source: DataFrame, keys: Sequence[str], update: Sequence[str], insert_only: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One row per key, and apart from them the rows without a key, which match nothing."""
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    named = source.select(*dict.fromkeys([*keys, *update, *insert_only, *order]))
    return merge.last_per_key(named.where(has_key), keys, list(update), list(insert_only), order), named.where(~has_key).drop(*order)


class TableTarget:
    """A table of a format with row-level writes (Iceberg, Delta), by its catalog name. A load is one transaction of the format."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        df.writeTo(self.name).append()

    def full_refresh(self, df: DataFrame) -> None:
        df.writeTo(self.name).overwrite(F.lit(True))

    def replace_window(self, new_rows: DataFrame, window: Column) -> None:
        new_rows.writeTo(self.name).overwrite(window)

    def _merged(self, rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column]):
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(f"{self.name}.{k}") == F.col(f"source.{k}"))
        return rows.alias("source").mergeInto(self.name, same).whenMatched().update(dict(values))

    def merge(
        self, source: DataFrame, keys: Sequence[str], *, update: Sequence[str] | None = None, insert_only: Sequence[str] = (),
        constants: Mapping[str, object] | None = None, order: Sequence[str] = (),
    ) -> None:
        constants = {c: F.lit(v) for c, v in (constants or {}).items()}
        if update is None:
            update = [c for c in source.columns if c not in {*keys, *insert_only, *constants, *order}]
        rows, keyless = folded_source(source, keys, update, insert_only, order)
        both = {c: F.col(f"source.{c}") for c in update} | constants
        new = {c: F.col(f"source.{c}") for c in (*keys, *insert_only)} | both
        self._merged(rows, keys, both).whenNotMatched().insert(new).merge()
        self.append(keyless.withColumns(constants) if constants else keyless)

    def update(self, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()) -> None:
        rows, _ = folded_source(source, keys, update, (), order)
        self._merged(rows, keys, {c: F.col(f"source.{c}") for c in update}).merge()

    def refresh_from(self, loaded: Target, columns: Sequence[str]) -> None:
        self.full_refresh(merge.derived_distinct(loaded.read(), columns))


def window_statements(table: str, staging: str, columns: Sequence[str], window_sql: str) -> list[str]:
    names = ", ".join(columns)
    return [f"DELETE FROM {table} WHERE {window_sql}", f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}"]


def merge_statement(
    table: str, staging: str, keys: Sequence[str], update: Sequence[str], insert_only: Sequence[str] = (), constants: Mapping[str, str] | None = None, insert: bool = True
) -> str:
    """One MERGE from the staging table. ``constants`` are SQL literals. Null keys match nothing and are inserted."""
    constants = constants or {}
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join([*(f"t.{c} = s.{c}" for c in update), *(f"t.{c} = {v}" for c, v in constants.items())])
    statement = f"MERGE INTO {table} t USING {staging} s ON ({on})"
    if sets:
        statement += f" WHEN MATCHED THEN UPDATE SET {sets}"
    if insert:
        columns = [*keys, *update, *insert_only]
        names, values = ", ".join([*columns, *constants]), ", ".join([*(f"s.{c}" for c in columns), *constants.values()])
        statement += f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    return statement


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


class JdbcTarget:
    """A database table: rows go into a staging table in parallel, then statements of the database move them in one transaction.

    ``execute`` runs a list of statements in one transaction on the database (Spark has no call for that);
    ``window_sql`` is the plan's window in the database's words.
    """

    def __init__(self, spark: SparkSession, url: str, table: str, execute: Callable[[list[str]], None], window_sql: str = "", **options: str):
        self.spark, self.url, self.table, self.execute, self.window_sql, self.options = spark, url, table, execute, window_sql, options
        self.staging = f"{table}_staging"

    def read(self) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=self.table, **self.options).load()

    def append(self, df: DataFrame) -> None:
        jdbc_append(df, self.url, self.table, **self.options)

    def full_refresh(self, df: DataFrame) -> None:
        jdbc_full_refresh(df, self.url, self.table, **self.options)

    def _stage(self, df: DataFrame) -> None:
        jdbc_full_refresh(df, self.url, self.staging, **self.options)

    def replace_window(self, new_rows: DataFrame, window: Column) -> None:
        if not self.window_sql:
            raise ValueError("give window_sql, the window in the database's words")
        self._stage(new_rows)
        self.execute(window_statements(self.table, self.staging, new_rows.columns, self.window_sql))

    def merge(
        self, source: DataFrame, keys: Sequence[str], *, update: Sequence[str] | None = None, insert_only: Sequence[str] = (),
        constants: Mapping[str, object] | None = None, order: Sequence[str] = (),
    ) -> None:
        literals = {c: sql_literal(v) for c, v in (constants or {}).items()}
        if update is None:
            update = [c for c in source.columns if c not in {*keys, *insert_only, *literals, *order}]
        rows, keyless = folded_source(source, keys, update, insert_only, order)
        self._stage(rows.unionByName(keyless))
        self.execute([merge_statement(self.table, self.staging, keys, update, insert_only, literals)])

    def update(self, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()) -> None:
        rows, _ = folded_source(source, keys, update, (), order)
        self._stage(rows)
        self.execute([merge_statement(self.table, self.staging, keys, update, insert=False)])

    def refresh_from(self, loaded: Target, columns: Sequence[str]) -> None:
        self.full_refresh(merge.derived_distinct(loaded.read(), columns))
