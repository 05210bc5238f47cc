"""Target tables kept as Parquet folders, and JDBC targets."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftload.sinks import merge
from siftload.sinks.folder import VersionedFolder
from siftload.sources.staging import staged
from siftload.sources.tables import checked_broadcast

JDBC_BATCH = 15_000
# The folders below a version in which a target with load ids keeps each load's rows, and the name of all rows before them.
LOAD = "__load"
BASE = "base"
# Keys that a search pushes to the scan as a list; more of them are joined.
MOST_PUSHED = 1000
# Marks to note with a load; one that is None stays as it was.
Marks = Mapping[str, str | None] | None


class ParquetTarget:
    """A target table in one folder.

    Whole-table loads write a new version and switch to it in one step (``VersionedFolder``), so a job that stops at any
    moment leaves the old content or the new one. With ``partition_by``, window loads, upserts and keyed updates
    rewrite only the partitions they touch. Such a rewrite is a dynamic partition overwrite: if it stops half-way, some
    partitions are new and some old, and repeating the load sets all of them right.

    With ``load_ids`` every append has an id, and its rows lie in a folder of that id. Appending under an id again replaces
    that folder, so a load repeated after a stop at any step is one copy. All other loads fold the appended rows into one
    content and note the ids it holds; an append under one of those is left out.

    ``key_index`` names a key column that upserts look for: files are sorted by it and carry a Bloom filter of it per row
    group (``row_group_bytes``). The search for the partitions that a small upsert touches then sends the keys to the scan,
    which skips the row groups that can't hold one.

    ``marks`` are texts noted with a load: how far it has read its source. They count from the same moment as the load
    does, or, where partitions are rewritten, right after it.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType | str | None = None, partition_by: Sequence[str] = (), load_ids: bool = False,
        key_index: str | None = None, row_group_bytes: int = 32 << 20,
    ):
        if load_ids and partition_by:
            raise ValueError("a target keeps its rows by load id or by partition columns, not both")
        self.load_ids = load_ids
        self.key_index, self.row_group_bytes = key_index, row_group_bytes
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by)
        self.versions = VersionedFolder(spark, self.path)

    def folder(self) -> str | None:
        """Where the current content lies; None before the first load."""
        return self.versions.current()

    def exists(self) -> bool:
        return self.folder() is not None

    def read(self) -> DataFrame:
        folder = self.folder()
        if folder is None:
            if self.schema is None:
                raise FileNotFoundError(f"{self.path} has no content yet and no schema was given")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(folder).drop(LOAD) if self.load_ids else reader.parquet(folder)

    def marks(self) -> dict[str, str]:
        """The marks noted by the loads so far, the last one of each name."""
        return dict(self.versions.notes().get("marks", {}))

    def _notes(self, marks: Marks, loads: Sequence[str] | None = None) -> dict[str, object]:
        notes = self.versions.notes()
        new = {"marks": {**notes.get("marks", {}), **{k: v for k, v in (marks or {}).items() if v is not None}}}
        kept = notes.get("loads", []) if loads is None else list(loads)
        return new | ({"loads": kept} if kept else {})

    def note(self, marks: Marks) -> None:
        """Notes marks beside the content as it is."""
        if marks is not None and self.exists():
            self.versions.commit(self.folder(), self._notes(marks))

    def _loaded(self) -> list[str]:
        """Names of the loads in the content: those folded into it and those in folders of their own."""
        if not self.load_ids or not self.exists():
            return []
        folder = self.folder()[len(self.path) + 1 :]
        own = [n.split("=", 1)[1] for n in self.versions._names(folder) if n.startswith(f"{LOAD}=")]
        return sorted({*self.versions.notes().get("loads", []), *own} - {BASE})

    def _read_or_empty(self, like: DataFrame, constants: Mapping[str, object] | None = None) -> DataFrame:
        """Current content; before the first load no rows with the columns the load brings."""
        if self.schema is not None or self.exists():
            return self.read()
        return like.limit(0).withColumns({name: F.lit(value) for name, value in (constants or {}).items()})

    def _write(self, df: DataFrame, folder: str, mode: str, **options: str) -> None:
        if self.key_index:
            df = df.sortWithinPartitions(*self.partition_by, self.key_index)
            options |= {f"parquet.bloom.filter.enabled#{self.key_index}": "true", "parquet.bloom.filter.adaptive.enabled": "true", "parquet.block.size": str(self.row_group_bytes)}
        writer = df.write.mode(mode).options(**options)
        if self.load_ids:
            folder = f"{folder}/{LOAD}={BASE}"
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(folder)

    def _swap_in(self, df: DataFrame, marks: Marks = None, loads: Sequence[str] | None = None) -> None:
        version = self.versions.new_version()
        held = self._loaded() if loads is None else loads
        self._write(df, version, "errorifexists")
        self.versions.commit(version, self._notes(marks, held))

    def append(self, df: DataFrame, load_id: str | None = None, marks: Marks = None) -> bool:
        """Adds rows; False if the content already holds the load of that id for good."""
        if self.load_ids:
            return self._append_load(df, load_id, marks)
        if load_id is not None:
            raise ValueError("the target was not made for load ids")
        self._append(df)
        self.note(marks)
        return True

    def _append_load(self, df: DataFrame, load_id: str | None, marks: Marks) -> bool:
        if load_id is None:
            raise ValueError("every append to this target needs a load id")
        name = hashlib.sha256(load_id.encode()).hexdigest()[:32]
        if name in self.versions.notes().get("loads", []):
            return False
        if not self.exists():
            self._swap_in(df.limit(0))
        df.write.mode("overwrite").parquet(f"{self.folder()}/{LOAD}={name}")
        self.note(marks)
        return True

    def _append(self, df: DataFrame) -> None:
        folder = self.folder()
        if folder is None:
            self._swap_in(df)
        else:
            self._write(df, folder, "append")

    def full_refresh(self, df: DataFrame, marks: Marks = None) -> None:
        """New content. Loads appended before are forgotten with it, marks are kept."""
        self._swap_in(df, marks, loads=[])

    def replace_window(self, new_rows: DataFrame, window: Column, marks: Marks = None) -> None:
        """Replaces the rows inside ``window`` by ``new_rows``; of a partitioned target only partitions with either."""
        if not self.partition_by or not self.exists():
            self._swap_in(merge.replace_window(self._read_or_empty(new_rows), new_rows, window), marks)
            return
        current, staged_rows = self.read(), staged(new_rows)
        touched = self._places(current.where(window), staged_rows)
        self._rewrite(current, touched, lambda affected: merge.replace_window(affected, staged_rows, window))
        self.note(marks)

    def replace_partitions(self, new_rows: DataFrame) -> None:
        """Replaces the partitions that ``new_rows`` has rows in, and touches no other."""
        if not self.partition_by:
            raise ValueError("the target is not partitioned")
        folder = self.folder()
        if folder is None:
            self._swap_in(new_rows)
        else:
            self._write(new_rows, folder, "overwrite", partitionOverwriteMode="dynamic")

    def stage(self, df: DataFrame) -> tuple[DataFrame, int]:
        rows = staged(df)
        return rows, rows.count()

    def merge(self, source: DataFrame, keys: Sequence[str], marks: Marks = None, **how) -> int:
        """Upsert. A partitioned target rewrites only the partitions the source touches."""
        staged_rows, rows = self.stage(source)
        current = self._read_or_empty(staged_rows, how.get("constants"))
        if self.partition_by and self.exists():
            self._merge_partitions(current, staged_rows, keys, rows, **how)
            self.note(marks)
        else:
            self._swap_in(merge.merge_upsert(current, staged_rows, keys, source_rows=rows, **how), marks)
        return rows

    def _merge_partitions(self, current: DataFrame, staged_rows: DataFrame, keys: Sequence[str], rows: int, **how) -> None:
        """Partitions of the rows to update and of the rows to insert. A row must keep its partition."""
        update = how.get("update")
        if update is None:
            update = [c for c in staged_rows.columns if c not in {*keys, *how.get("insert_only", ())}]
        self._refuse_moves(update)
        # A column the source lacks starts as null, and so does the partition of the rows it inserts.
        given = [F.col(c) if c in staged_rows.columns else F.lit(None).alias(c) for c in self.partition_by]
        touched = self._places(self.rows_with_keys(staged_rows, keys), staged_rows.select(*given))
        self._rewrite(current, touched, lambda affected: merge.merge_upsert(affected, staged_rows, keys, source_rows=rows, **how))

    def update(self, source: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[str] = ()) -> int:
        """Sets columns of known keys. A partitioned target rewrites only the partitions that hold one."""
        staged_rows, rows = self.stage(source)
        current = self.read()
        if not self.partition_by or not self.exists():
            self._swap_in(merge.keyed_update(current, staged_rows, keys, update, order))
            return rows
        self._refuse_moves(update)
        touched = self._places(self.rows_with_keys(staged_rows, keys))
        self._rewrite(current, touched, lambda affected: merge.keyed_update(affected, staged_rows, keys, update, order))
        return rows

    def rows_with_keys(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The target's rows that have a key of ``source``. Few keys of the indexed column are pushed to the scan."""
        wanted = source.select(*keys).distinct()
        if list(keys) == [self.key_index]:
            few = [r[0] for r in wanted.where(F.col(self.key_index).isNotNull()).limit(MOST_PUSHED + 1).collect()]
            if len(few) <= MOST_PUSHED:
                return self.read().where(F.col(self.key_index).isin(*few) if few else F.lit(False))
        return self.read().join(checked_broadcast(wanted), list(keys), "left_semi")

    def _refuse_moves(self, update: Sequence[str]) -> None:
        moving = sorted(set(update) & set(self.partition_by))
        if moving:
            raise ValueError(f"partition columns {moving} may be set on insert only")

    def _places(self, *frames: DataFrame) -> DataFrame:
        """The partitions with rows in any of the frames, once each."""
        types = self.read().schema
        places = [f.select(*[F.col(c).cast(types[c].dataType).alias(c) for c in self.partition_by]) for f in frames]
        all_places = places[0]
        for more in places[1:]:
            all_places = all_places.unionByName(more)
        return staged(all_places.distinct())

    def _in(self, df: DataFrame, places: DataFrame, how: str) -> DataFrame:
        """Rows in ``places`` (left_semi) or not (left_anti). The null partition is one like any other."""
        named = checked_broadcast(places.select(*[F.col(c).alias(f"__p_{c}") for c in self.partition_by]))
        same = F.lit(True)
        for c in self.partition_by:
            same = same & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
        return df.join(named, same, how)

    def _rewrite(self, current: DataFrame, touched: DataFrame, change) -> None:
        """New content for the touched partitions. One that ends up empty is removed, as an overwrite leaves it."""
        affected = self._in(current, touched, "left_semi")
        content = staged(change(affected.select(*current.columns)))
        emptied = staged(self._in(touched, content.select(*self.partition_by).distinct(), "left_anti"))
        folders: list[str] = []
        if not emptied.isEmpty():
            file = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
            # At most as many names as there are partitions to remove.
            folders = [r["folder"] for r in self._in(current.select("*", file), emptied, "left_semi").select("folder").distinct().collect()]
        self._write(content, self.folder(), "overwrite", partitionOverwriteMode="dynamic")
        for folder in folders:
            self.versions.delete(folder)

    def refresh_from(self, loaded: ParquetTarget, columns: Sequence[str]) -> None:
        self.full_refresh(merge.derived_distinct(loaded.read(), columns))


def jdbc_write_options(url: str, table: str, *, num_partitions: int = 16, batch: int = JDBC_BATCH, **extra: str) -> Mapping[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(num_partitions), **extra}


def jdbc_append(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").mode("append").options(**jdbc_write_options(url, table, **options)).save()


def jdbc_full_refresh(df: DataFrame, url: str, table: str, **options) -> None:
    """Truncates and refills, keeping the table's definition and rights."""
    df.write.format("jdbc").mode("overwrite").options(**jdbc_write_options(url, table, truncate="true", **options)).save()
