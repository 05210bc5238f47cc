"""Load modes as pure plans: target frame and new rows in, the target's next content out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.sources.tables import MAX_BROADCAST_ROWS, fits_broadcast


def project_to_target(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Target columns in target order. ``renames`` maps target column to source column; the rest is dropped."""
    renames = renames or {}
    return df.select(*[F.col(renames.get(c, c)).alias(c) for c in columns])


def last_per_key(
    source: DataFrame, keys: Sequence[str], latest: Sequence[str], earliest: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: ``latest`` columns of its last row and ``earliest`` columns of its first.

    That is what applying the rows one by one gives: the first inserts, the later ones update. Ties in the
    order are broken by all other columns. Rows are combined before the shuffle, so a hot key is no burden.
    """
    rest = [c for c in source.columns if c not in {*keys, *order}]
    position = F.struct(*[F.col(c) for c in (*order, *rest)])
    aggregates = []
    if latest:
        aggregates.append(F.max_by(F.struct(*latest), position).alias("__last"))
    if earliest:
        aggregates.append(F.min_by(F.struct(*earliest), position).alias("__first"))
    if not aggregates:
        return source.select(*keys).distinct()
    rows = source.groupBy(*keys).agg(*aggregates)
    return rows.select(
        *keys,
        *[F.col(f"__last.{c}").alias(c) for c in latest],
        *[F.col(f"__first.{c}").alias(c) for c in earliest],
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Sequence[str] | None = None,
    insert_only: Sequence[str] = (),
    constants: Mapping[str, object] | None = None,
    order: Sequence[str] = (),
    source_rows: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Next content of ``target``: rows with a known key are updated, the others inserted.

    ``update`` columns are set on both arms (default: every shared column that is neither key nor
    ``insert_only``), ``insert_only`` columns on insert, ``constants`` on both arms to a fixed value. Other
    target columns keep their value and start as null. A repeated source key counts as applied in ``order``.
    A source row with a null key matches nothing and is inserted.

    Rows without a key go around the join on either side. With a counted ``source_rows`` within the broadcast bound, in rows
    and in bytes, the target is not shuffled at all; otherwise both sides are shuffled once by key.
    """
    constants = constants or {}
    if update is None:
        skip = {*keys, *insert_only, *constants}
        update = [c for c in source.columns if c in target.columns and c not in skip]
    types = dict((f.name, f.dataType) for f in target.schema.fields)
    set_columns = [*update, *insert_only]
    named = source.select(*dict.fromkeys([*keys, *set_columns, *order]))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    keyless = named.where(null_key)
    once = last_per_key(named.where(~null_key), keys, list(update), list(insert_only), order)

    def inserted(df: DataFrame) -> DataFrame:
        given = {*keys, *set_columns}
        return df.select(
            *[
                (F.lit(constants[c]) if c in constants else F.col(c) if c in given else F.lit(None)).cast(types[c]).alias(c)
                for c in target.columns
            ]
        )

    src = once.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"__v_{c}") for c in set_columns],
        F.lit(True).alias("__in_source"),
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    from_source = F.col("__in_source").isNotNull()

    def merged(c: str, in_target: Column) -> Column:
        if c in keys:
            value = F.coalesce(F.col(c), F.col(f"__k{list(keys).index(c)}"))
        elif c in constants:
            value = F.when(from_source, F.lit(constants[c])).otherwise(F.col(c))
        elif c in update:
            value = F.when(from_source, F.col(f"__v_{c}")).otherwise(F.col(c))
        elif c in insert_only:
            value = F.when(in_target, F.col(c)).otherwise(F.col(f"__v_{c}"))
        else:
            value = F.col(c)
        return value.cast(types[c]).alias(c)

    if source_rows is not None and source_rows <= max_broadcast_rows and fits_broadcast(named, max_broadcast_rows):
        updated = target.join(F.broadcast(src), same, "left").select(*[merged(c, F.lit(True)) for c in target.columns])
        known = target.select(*keys).join(F.broadcast(src), same, "left_semi").distinct()
        fresh = once.join(F.broadcast(known), list(keys), "left_anti")
        return updated.unionByName(inserted(fresh)).unionByName(inserted(keyless))
    # Target rows with a null key match nothing; in the outer join they would all meet in one task.
    marked = target.where(~null_key).withColumn("__in_target", F.lit(True))
    both = marked.join(src, same, "full_outer").select(*[merged(c, F.col("__in_target").isNotNull()) for c in target.columns])
    return both.unionByName(target.where(null_key)).unionByName(inserted(keyless))


def keyed_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Sets ``update`` columns on all target rows with a source key, also to null; inserts nothing.

    Target rows without a key match nothing and go around the join, where they would all meet in one task.
    """
    types = dict((f.name, f.dataType) for f in target.schema.fields)
    once = last_per_key(source.dropna(subset=list(keys)), keys, list(update), [], order)
    src = once.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"__v_{c}") for c in update],
        F.lit(True).alias("__in_source"),
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    joined = target.where(~null_key).join(src, same, "left")
    updated = joined.select(
        *[
            F.when(F.col("__in_source").isNotNull(), F.col(f"__v_{c}")).otherwise(F.col(c)).cast(types[c]).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(target.where(null_key))


def replace_window(target: DataFrame, new_rows: DataFrame, window: Column) -> DataFrame:
    """Drops the target rows inside ``window`` and adds the new ones. A window that is null keeps the row."""
    return target.where(~F.coalesce(window, F.lit(False))).unionByName(new_rows)


def derived_distinct(target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content of a table derived from the loaded one: the distinct rows of some of its columns."""
    return target.select(*columns).distinct()


COUNT = "__rows"


def counted_distinct(target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of some columns, each with how many rows of the loaded table stand behind it."""
    return target.groupBy(*columns).agg(F.count(F.lit(1)).alias(COUNT))


def derived_change(derived: DataFrame, removed: DataFrame, added: DataFrame, columns: Sequence[str], max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Next content of a counted derived table after rows left the loaded table and others came.

    Only the distinct rows among those are changed: counts go up and down, a row with none left goes, a new one comes. The
    changes are added up before they are joined, null-safe, so a change that fits a broadcast doesn't shuffle the table.
    """
    moves = removed.select(*columns, F.lit(-1).alias("__by")).unionByName(added.select(*columns, F.lit(1).alias("__by")))
    changes = moves.groupBy(*columns).agg(F.sum("__by").alias("__by")).where("__by <> 0")
    changes = changes.select(*[F.col(c).alias(f"__d{i}") for i, c in enumerate(columns)], "__by")
    small = F.broadcast(changes) if fits_broadcast(changes, max_broadcast_rows) else changes
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & F.col(c).eqNullSafe(F.col(f"__d{i}"))
    left = F.col(COUNT) + F.coalesce(F.col("__by"), F.lit(0))
    short = F.raise_error(F.lit("more rows were removed than the derived table counts")).cast("long")
    changed = derived.join(small, same, "left").select(*columns, F.when(left < 0, short).otherwise(left).alias(COUNT)).where(F.col(COUNT) > 0)
    known = derived.join(small, same, "left_semi").select(*columns)
    # What the table doesn't know yet must come in; a removal of it would be an error that the count below shows.
    fresh = small.join(F.broadcast(known) if small is not changes else known, same, "left_anti")
    fresh = fresh.select(*[F.col(f"__d{i}").alias(c) for i, c in enumerate(columns)], F.when(F.col("__by") < 0, short).otherwise(F.col("__by")).alias(COUNT))
    return changed.unionByName(fresh)
