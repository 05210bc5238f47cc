"""Attribute-value tables: one row per (owner, name, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.functions.text import suffix_after_underscore
from siftload.sources.staging import staged


def eav_pivot(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Many name/value rows to one wide row per key. ``names`` maps attribute name to column.

    The names are given, so no job is spent to find them; names outside the list are filtered at the scan.
    Where a name repeats the largest value stays; use ``join_by_name`` when each of them must give a row.
    """
    picks = [F.max(F.when(F.col(name) == n, F.col(value))).alias(out) for n, out in names.items()]
    return df.where(F.col(name).isin(*names)).groupBy(*keys).agg(*picks)


def join_by_name(
    df: DataFrame, attributes: DataFrame, on: str, owner: str, where: Column, value: str, out: str, how: str = "left"
) -> DataFrame:
    """Adds the value of the attributes that satisfy ``where``; several matches give several rows.

    The name test stands on the right side only, so it is applied before the join.
    """
    picked = attributes.where(where).select(F.col(owner).alias("__owner"), F.col(value).alias(out))
    return df.join(picked, F.col(on) == F.col("__owner"), how).drop("__owner")


def any_like(c: Column, patterns: Sequence[str]) -> Column:
    out = c.like(patterns[0])
    for pattern in patterns[1:]:
        out = out | c.like(pattern)
    return out


def families_by_suffix(
    df: DataFrame, owner: str, name: str, value: str, families: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One pass that sorts attributes into families by name pattern and cuts their suffix.

    A name may belong to several families, so the families are exploded. Rows: owner, suffix, family, value.
    """
    tags = [F.when(any_like(F.col(name), patterns), F.lit(family)) for family, patterns in families.items()]
    tagged = df.select(
        F.col(owner).alias("owner"),
        suffix_after_underscore(F.col(name)).alias("suffix"),
        F.explode(F.array_compact(F.array(*tags))).alias("family"),
        F.col(value).alias("value"),
    )
    return tagged


def join_families(
    df: DataFrame, by_suffix: DataFrame, owner: str, suffix: str, families: Mapping[str, str]
) -> DataFrame:
    """Left joins the values of each family that share owner and suffix with the row.

    (owner, suffix) pairs with at most one value per family, nearly all of them, are pivoted in one
    aggregation. The values of the other pairs are written out once, split by family, and multiplied out
    by joins that each read their own family only. No row is lost or capped.
    """
    keys = ["owner", "suffix"]
    counted = by_suffix.groupBy(*keys).agg(
        *[F.max(F.when(F.col("family") == f, F.col("value"))).alias(out) for f, out in families.items()],
        F.greatest(F.lit(0), *[F.count(F.when(F.col("family") == f, F.lit(1))) for f in families]).alias("__most"),
    )
    on_pair = (F.col(owner) == F.col("owner")) & (F.col(suffix) == F.col("suffix"))
    single = df.join(counted, on_pair, "left").where(F.coalesce(F.col("__most"), F.lit(0)) <= 1)
    single = single.select(*df.columns, *families.values())

    several = by_suffix.groupBy(*keys, "family").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys).distinct()
    rest = staged(by_suffix.join(several, keys, "left_semi"), ["family"])
    if rest.isEmpty():
        return single
    pairs = rest.select(*keys).distinct()
    repeated = df.join(pairs, on_pair, "left_semi")
    for family, out in families.items():
        values = rest.where(F.col("family") == family).select(*keys, F.col("value").alias(out))
        repeated = repeated.join(values, on_pair, "left").drop(*keys)
    return single.unionByName(repeated)
