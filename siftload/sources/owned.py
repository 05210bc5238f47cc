"""Attribute tables laid out by owner once, for the plans of a run that each ask for the rows of some owners."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftload.session import work_dir
from siftload.sources.staging import staged

# Rows of one bucket: a bucket is read by one task. An owner with more than a quarter of that is a hot one.
ROWS_PER_BUCKET = 4_000_000
# What Spark allows by default (spark.sql.sources.bucketing.maxBuckets).
MOST_BUCKETS = 100_000
# A bucket with less costs a task that starts, commits and reports to the driver for next to no rows.
LEAST_BUCKET_BYTES = 16 << 20


@dataclass(frozen=True)
class OwnedRows:
    """Rows in buckets of their owner, but for those of hot owners and of none, which lie in ordinary files.

    A bucket can't be split when it is joined, so an owner with a large share of all rows must not be in one. Every hot
    owner has more than a quarter of a bucket's rows or bytes, so there are at most eight times as many as buckets; their
    list may be broadcast.
    """

    owner: str
    buckets: int
    bucketed: DataFrame
    rest: DataFrame | None
    hot: DataFrame | None

    def of(self, wanted: DataFrame, key: str) -> DataFrame:
        """Rows whose owner is among the values of ``key``. Only the wanted ids are shuffled, never the rows."""
        ids = wanted.select(F.col(key).alias("__id"))
        same = F.col(self.owner) == F.col("__id")
        found = self.bucketed.join(ids, same, "left_semi")
        if self.hot is None:
            return found
        hot_ids = self.hot.join(ids, same, "left_semi").withColumnRenamed(self.owner, "__id")
        return found.unionByName(self.rest.join(F.broadcast(hot_ids), same, "left_semi"))

    def whole(self) -> DataFrame:
        return self.bucketed if self.rest is None else self.bucketed.unionByName(self.rest)


def buckets_for(rows: int, rows_per_bucket: int, least: int) -> int:
    """At least as many as shuffles have partitions: beneath that Spark would rather shuffle both sides."""
    return min(MOST_BUCKETS, max(least, -(-rows // rows_per_bucket)))


def fixed_bytes(df: DataFrame) -> int:
    """What a row of the schema takes at least."""
    return 16 * len(df.columns) + 16


def row_bytes(df: DataFrame) -> Column:
    """What a row takes: texts counted as they are, nested values by their text."""
    size = F.lit(fixed_bytes(df)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(df[f"`{f.name}`"]), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(df[f"`{f.name}`"].cast("string")), F.lit(0))
    return size


@contextmanager
def owned_rows(df: DataFrame, owner: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Iterator[OwnedRows]:
    """Lays ``df`` out by ``owner`` for the block, with one shuffle of it. Rows are counted per owner first.

    Every bucket is a task that writes it, and one more for each join. If ``rows_per_bucket`` rows may take less than
    ``LEAST_BUCKET_BYTES``, the count measures them too, and there are only as many buckets beyond the least number as the
    bytes fill: tasks, and what they report to the driver, then grow with the bytes, however few rows a bucket was to have.

    The buckets are a table of the session's catalog, with its files in the shared work folder and a name of its own; it is
    dropped at the end of the block, while the files go with the work area. A driver that dies leaves both behind. An
    empty table gives empty buckets. Owner names and all other columns stay as they are.
    """
    spark = df.sparkSession
    measured = rows_per_bucket * fixed_bytes(df) < LEAST_BUCKET_BYTES
    of_owner = F.sum(row_bytes(df)) if measured else F.lit(0)
    counted = staged(df.groupBy(owner).agg(F.count(F.lit(1)).alias("__n"), of_owner.alias("__bytes")))
    rows, size = counted.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in ("__n", "__bytes")]).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets_for(rows, rows_per_bucket, least)
    if measured:
        buckets = min(buckets, buckets_for(size, LEAST_BUCKET_BYTES, least))
    bound = max(-(-rows // buckets), rows_per_bucket) // 4
    bytes_bound = max(-(-size // buckets), LEAST_BUCKET_BYTES) // 4
    apart = counted.where((F.col("__n") > bound) | (F.col("__bytes") > bytes_bound) | F.col(owner).isNull())
    hot = apart.where(F.col(owner).isNotNull()).select(owner)
    some_apart = not apart.isEmpty()
    rest = None
    near = df
    if some_apart:
        is_hot = hot.select(F.col(owner).alias("__hot"))
        flagged = df.join(F.broadcast(is_hot), F.col(owner) == F.col("__hot"), "left")
        rest = staged(flagged.where(F.col("__hot").isNotNull() | F.col(owner).isNull()).drop("__hot"))
        near = flagged.where(F.col("__hot").isNull() & F.col(owner).isNotNull()).drop("__hot")
    table = f"owned_{uuid.uuid4().hex}"
    near.repartition(buckets, owner).write.bucketBy(buckets, owner).sortBy(owner).option("path", work_dir(spark)).saveAsTable(table)
    try:
        yield OwnedRows(owner, buckets, spark.table(table), rest, hot if some_apart else None)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@contextmanager
def all_owned(frames: Mapping[str, tuple[DataFrame, str]]) -> Iterator[dict[str, OwnedRows]]:
    """Several tables, each with its owner column, laid out for the block."""
    with ExitStack() as stack:
        yield {name: stack.enter_context(owned_rows(df, owner)) for name, (df, owner) in frames.items()}
