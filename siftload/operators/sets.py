"""Unions and distinct rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.sources.staging import staged


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stacks frames by column name."""
    out = first
    for other in others:
        out = out.unionByName(other)
    return out


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stacks frames by position under the names of the first, and drops repeated rows."""
    out = first
    for other in others:
        out = out.union(other.toDF(*first.columns))
    return out.distinct()


def distinct_wide(df: DataFrame) -> DataFrame:
    """Distinct rows of a wide frame, of which only a hash of each row is shuffled.

    The rows are staged with 128 bits of hash. Hashes are counted, with partial counts before the shuffle; rows whose hash
    stands once are distinct as they are, and only the others are compared as a whole. So different rows with one hash both
    stay. Values that are equal for ``distinct`` hash alike; null flags are hashed, too, so that a value that moves to the
    next column changes the hash. Columns can't be maps, as for ``distinct``.
    """
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns]) if df.columns else F.lit("")
    hashes = {f"__h{seed}": F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in df.columns]) for seed in (1, 2)}
    held = staged(df.withColumns(hashes))
    repeated = staged(held.groupBy(*hashes).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*hashes))
    if repeated.isEmpty():
        return held.drop(*hashes)
    once = held.join(repeated, list(hashes), "left_anti").select(*df.columns)
    return once.unionByName(held.join(repeated, list(hashes), "left_semi").select(*df.columns).distinct())
