"""Row numbers, first and last rows per group, and ranked pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn") -> DataFrame:
    """``row_number`` per group. Followed by a filter ``out <= k`` Spark keeps k rows per group before the
    shuffle, so a hot group is no burden. For the numbers of all rows of hot groups see ``rank_split_groups``."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def rank_split_groups(
    df: DataFrame, keys: Sequence[str], slice_of: Column, order: Sequence[Column], out: str = "rn"
) -> DataFrame:
    """``row_number`` of every row where one group may hold a large part of the table.

    ``slice_of`` cuts each group into runs that follow the order (a day of a time, a range of a number).
    Rows are numbered inside their slice; the slice's start comes from the slice counts, which are added up
    before the shuffle. So no task ever sees more than one slice of a group.
    """
    sliced = df.withColumn("__slice", slice_of)
    by_slice = [*keys, "__slice"]
    counts = sliced.groupBy(*by_slice).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"__s{i}") for i, c in enumerate(by_slice)],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    local = sliced.withColumn("__rn", F.row_number().over(Window.partitionBy(*by_slice).orderBy(*order)))
    same = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(by_slice)]
    condition = same[0]
    for extra in same[1:]:
        condition = condition & extra
    joined = local.join(starts, condition)
    return joined.select(*df.columns, (F.col("__before") + F.col("__rn")).cast("int").alias(out))


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group, the first in the order. Only the leading row of each map task is shuffled."""
    return rank_within_group(df, keys, order, "__rn").where("__rn = 1").drop("__rn")


def all_first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Every row that ties for first place, as a join back on the group minimum gives."""
    ranked = df.withColumn("__rank", F.rank().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def pivot_ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, outs: Sequence[str]
) -> DataFrame:
    """The first ``len(outs)`` values per group as columns, the rest dropped."""
    ranked = rank_within_group(df, keys, order, "__rn").where(F.col("__rn") <= len(outs))
    picks = [F.max(F.when(F.col("__rn") == i, F.col(value))).alias(name) for i, name in enumerate(outs, start=1)]
    return ranked.groupBy(*keys).agg(*picks)


def max_id(c: Column, *, text_order: bool = True) -> Column:
    """Largest id of a group. Ids are text: alphabetic by default, by their number with ``text_order=False``."""
    return F.max(c) if text_order else F.max_by(c, c.try_cast("bigint"))
