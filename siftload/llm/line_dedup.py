"""Lines that stand in many documents, dropped by an index that takes documents in and out again.

A line's key is the line without ASCII blanks at its ends, A-Z in lower case; in the index it is two 64-bit hashes. The
index holds, as Parquet below one folder:

    counts    hi, lo, docs: in how many documents each key stands, exactly
    filters   shard, table, false_hits: a cuckoo filter of the shard's keys that reach ``min_docs``, and the keys of
              ``counts`` that it takes for such a key wrongly
    batches   the names of the batches taken in or out

A key is dropped if its shard's filter holds it and it is no false hit. Since false hits are worked out against all counted
keys of the shard, that is exact for every document in the index, and both together need about two bytes per dropped key
where the keys themselves need sixteen. Taking documents out lowers the counts; a key that falls below ``min_docs`` leaves
the filter, so afterwards the index answers as if they had never come in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftload.llm.common import ascii_lower, importable
from siftload.session import work_dir
from siftload.sinks.folder import VersionedFolder

BLANKS = " \t\n\x0b\x0c\r"
# Counted keys of one shard on average, at most; the number of shards is a power of two.
KEYS_PER_SHARD = 1 << 19
# Bytes of filters and false hits that every worker is sent. Beyond that lines are joined with the counts.
MOST_SENT = 64 << 20
SLOTS = 4
MOST_KICKS = 500
ADDED = ("n_lines", "n_dropped", "kept")


# ---------------------------------------------------------------- cuckoo filters


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def marks(hi: np.ndarray) -> np.ndarray:
    """The 16 bits of a key that a filter stores; 0 is an empty slot."""
    return (_mix(hi.astype(np.int64).view(np.uint64)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


def homes(lo: np.ndarray, mark: np.ndarray, mask: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The two buckets of each key. Either follows from the other and the mark, so a mark can move without its key."""
    mask = np.asarray(mask, np.uint64)
    one = _mix(lo.astype(np.int64).view(np.uint64)) & mask
    return one.astype(np.int64), (one ^ (_mix(mark.astype(np.uint64)) & mask)).astype(np.int64)


@dataclass
class CuckooFilter:
    """Marks in buckets of four, each in one of its key's two buckets. ``slots`` has one row per bucket."""

    slots: np.ndarray

    @staticmethod
    def sized_for(keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.85 < keys:
            buckets *= 2
        return CuckooFilter(np.zeros((buckets, SLOTS), np.uint16))

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """Whether all keys found a place. If not, the filter is too full and has to be built anew."""
        mark = marks(hi)
        one, two = homes(lo, mark, len(self.slots) - 1)
        slots = self.slots.tolist()
        fits = True
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist(), strict=True):
            at = a if 0 in slots[a] else b
            for kick in range(MOST_KICKS):
                if 0 in slots[at]:
                    slots[at][slots[at].index(0)] = m
                    break
                # Another mark makes room and goes to its other bucket.
                moved = kick % SLOTS
                m, slots[at][moved] = slots[at][moved], m
                at = int(at ^ (int(_mix(np.array([m], np.uint64))[0]) & (len(slots) - 1)))
            else:
                fits = False
                break
        self.slots = np.array(slots, np.uint16).reshape(-1, SLOTS)
        return fits

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out keys that are in; equal marks of other keys in the same bucket keep their places."""
        mark = marks(hi)
        for m, a, b in zip(mark.tolist(), *(h.tolist() for h in homes(lo, mark, len(self.slots) - 1)), strict=True):
            row = self.slots[a if m in self.slots[a] else b]
            row[np.flatnonzero(row == m)[0]] = 0

    def holds(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark = marks(hi)
        one, two = homes(lo, mark, len(self.slots) - 1)
        return (self.slots[one] == mark[:, None]).any(1) | (self.slots[two] == mark[:, None]).any(1)

    def to_bytes(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> CuckooFilter:
        return CuckooFilter(np.frombuffer(raw, "<u2").reshape(-1, SLOTS).copy())


def updated_filter(old: bytes | None, hi: np.ndarray, lo: np.ndarray, before: np.ndarray, after: np.ndarray, min_docs: int) -> tuple[bytes, bytes]:
    """A shard's filter and false hits after its counts changed, from its filter before. Without one it is built anew."""
    wanted, was = after >= min_docs, before >= min_docs
    kept = None
    if old is not None:
        kept = CuckooFilter.from_bytes(old)
        kept.delete(hi[was & ~wanted], lo[was & ~wanted])
        if int(wanted.sum()) > 0.9 * kept.slots.size or not kept.insert(hi[wanted & ~was], lo[wanted & ~was]):
            kept = None
    room = int(wanted.sum())
    while kept is None:
        kept = CuckooFilter.sized_for(room)
        if not kept.insert(hi[wanted], lo[wanted]):
            kept, room = None, max(2 * room, 8)
    wrong = (after > 0) & ~wanted
    wrong[wrong] = kept.holds(hi[wrong], lo[wrong])
    return kept.to_bytes(), np.stack([hi[wrong], lo[wrong]], 1).astype("<i8").tobytes()


@dataclass
class Probe:
    """The filters of all shards end to end, for one look-up of many keys."""

    slots: np.ndarray
    begins: np.ndarray
    masks: np.ndarray
    false_hi: np.ndarray
    false_lo: np.ndarray
    most_alike: int

    @staticmethod
    def of(rows: list[tuple[int, bytes, bytes]], shards: int) -> Probe:
        """Shards without a row hold nothing."""
        tables = {s: np.frombuffer(t, "<u2").reshape(-1, SLOTS) for s, t, _ in rows}
        none = np.zeros((1, SLOTS), np.uint16)
        parts = [tables.get(s, none) for s in range(shards)]
        sizes = np.array([len(p) for p in parts], np.int64)
        false = np.concatenate([np.zeros((0, 2), np.int64), *(np.frombuffer(f, "<i8").reshape(-1, 2) for _, _, f in rows)])
        false = false[np.argsort(false[:, 0], kind="stable")]
        alike = int(np.unique(false[:, 0], return_counts=True)[1].max()) if len(false) else 0
        return Probe(np.concatenate(parts), np.cumsum(sizes) - sizes, (sizes - 1).astype(np.uint64), false[:, 0].copy(), false[:, 1].copy(), alike)

    def holds(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        shard = hi & (len(self.begins) - 1)
        mark = marks(hi)
        one, two = homes(lo, mark, self.masks[shard])
        begin = self.begins[shard]
        hit = (self.slots[begin + one] == mark[:, None]).any(1) | (self.slots[begin + two] == mark[:, None]).any(1)
        at = np.flatnonzero(hit)
        first = np.searchsorted(self.false_hi, hi[at])
        for step in range(self.most_alike):
            place = np.minimum(first + step, len(self.false_hi) - 1)
            hit[at[(self.false_hi[place] == hi[at]) & (self.false_lo[place] == lo[at])]] = False
        return hit


# ---------------------------------------------------------------- lines


def lines(text: Column) -> Column:
    """The text's lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column) -> Column:
    return F.transform(lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(BLANKS)))


def key_hashes(keys: Column, min_chars: int) -> tuple[Column, Column]:
    """Two arrays of hashes, null where a key is too short."""

    def hashed(seed: int) -> Column:
        return F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, F.xxhash64(F.lit(seed), k)))

    return hashed(1), hashed(2)


class LineIndex:
    """Counts and filters of lines in a folder. Every change is one new version, which counts once it is complete.

    ``docs`` are rows with a text; a row is a document, also where ids or whole rows repeat. Null and empty texts have one
    empty line. Keys of fewer than ``min_chars`` code points are never counted or dropped.
    """

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = 10, min_chars: int = 1, keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.min_docs, self.min_chars, self.keys_per_shard = spark, min_docs, max(1, min_chars), keys_per_shard
        self.versions = VersionedFolder(spark, folder)

    def _read(self, name: str, schema: str) -> DataFrame:
        version = self.versions.current()
        return self.spark.createDataFrame([], schema) if version is None else self.spark.read.schema(schema).parquet(f"{version}/{name}")

    @property
    def counts(self) -> DataFrame:
        return self._read("counts", "hi long, lo long, before long, docs long").where("docs > 0").select("hi", "lo", "docs")

    @property
    def filters(self) -> DataFrame:
        return self._read("filters", "shards int, shard int, table binary, false_hits binary")

    @property
    def batches(self) -> DataFrame:
        return self._read("batches", "batch string")

    def insert(self, docs: DataFrame, batch: str, text: str = "text") -> None:
        """Takes documents in. A batch that was taken in already changes nothing, so a repeated load counts once."""
        self._change(docs, f"+{batch}", 1, text)

    def delete(self, docs: DataFrame, batch: str, text: str = "text") -> None:
        """Takes documents out that are in, once per batch. It fails if a line would be in fewer than no documents."""
        self._change(docs, f"-{batch}", -1, text)

    def _change(self, docs: DataFrame, batch: str, sign: int, text: str) -> None:
        if not self.batches.where(F.col("batch") == batch).isEmpty():
            return
        importable(self.spark)
        keys = F.filter(F.array_distinct(line_keys(F.col(text))), lambda k: F.length(k) >= self.min_chars)
        one = docs.select(F.explode(keys).alias("key")).select(
            F.xxhash64(F.lit(1), "key").alias("hi"), F.xxhash64(F.lit(2), "key").alias("lo"), F.lit(0).cast("long").alias("before"), F.lit(sign).cast("long").alias("change")
        )
        held = self.counts.select("hi", "lo", F.col("docs").alias("before"), F.lit(0).cast("long").alias("change"))
        sums = one.unionByName(held).groupBy("hi", "lo").agg(F.sum("before").alias("before"), F.sum("change").alias("change"))
        after = F.col("before") + F.col("change")
        short = F.raise_error(F.lit(f"batch {batch} takes out lines that are not in the index")).cast("long")
        version = self.versions.new_version()
        sums.select("hi", "lo", "before", F.when(after < 0, short).otherwise(after).alias("docs")).write.parquet(f"{version}/counts")
        self._write_filters(version)
        self.batches.unionByName(self.spark.createDataFrame([(batch,)], "batch string")).coalesce(1).write.parquet(f"{version}/batches")
        self.versions.commit(version)

    def _write_filters(self, version: str) -> None:
        """Each shard's filter from its filter before and its changed counts; all anew where the shards grow in number."""
        counts = self.spark.read.parquet(f"{version}/counts")
        shards, min_docs = 1, self.min_docs
        while shards * self.keys_per_shard < counts.count():
            shards *= 2
        old = self.filters.where(F.col("shards") >= shards)
        known = old.agg(F.max("shards")).first()[0]
        shards = known or shards

        def update(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(keys):
                return pd.DataFrame({"shards": [], "shard": [], "table": [], "false_hits": []})
            columns = [keys[c].to_numpy(np.int64) for c in ("hi", "lo", "before", "docs")]
            table, false = updated_filter(held["table"].iloc[0] if len(held) else None, *columns, min_docs)
            return pd.DataFrame({"shards": [shards], "shard": [int(keys["shard"].iloc[0])], "table": [table], "false_hits": [false]})

        # A power of two, so the lowest bits of the first hash are the shard.
        sharded = counts.withColumn("shard", F.col("hi").bitwiseAND(F.lit(shards - 1).cast("long")).cast("int"))
        grouped = sharded.groupBy("shard").cogroup(old.groupBy("shard"))
        grouped.applyInPandas(update, self.filters.schema).write.parquet(f"{version}/filters")

    def clean(self, docs: DataFrame, text: str = "text", most_sent: int = MOST_SENT) -> DataFrame:
        """The rows of ``docs``, all of them in the index, with n_lines, n_dropped and kept.

        Lines whose keys stand in at least ``min_docs`` documents are dropped in every document; ``kept`` is the others
        joined by \\n (the empty text if none is left, never null). Other columns pass; those named as the new ones are
        replaced. Filters of up to ``most_sent`` bytes go to the lines; beyond that hashes of lines are joined with the counts.
        """
        importable(self.spark)
        names = [c for c in docs.columns if c not in ADDED or c == text]
        hi, lo = key_hashes(line_keys(F.col(text)), self.min_chars)
        size = self.filters.agg(F.sum(F.octet_length("table") + F.octet_length("false_hits")).cast("long")).first()[0] or 0
        rows = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(names)], lines(F.col(text)).alias("__lines"), hi.alias("__hi"), lo.alias("__lo"))
        done = self._by_filter(rows) if size <= most_sent else self._by_join(rows)
        n_lines = F.size("__lines").cast("long")
        return done.select(
            *[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)],
            n_lines.alias("n_lines"),
            (n_lines - F.size("__kept")).alias("n_dropped"),
            F.array_join("__kept", "\n").alias("kept"),
        )

    def _by_filter(self, rows: DataFrame) -> DataFrame:
        held = self.filters.select("shards", "shard", "table", "false_hits").collect()  # within the bound on bytes
        shards = held[0]["shards"] if held else 1
        probe = self.spark.sparkContext.broadcast(Probe.of([(r["shard"], bytes(r["table"]), bytes(r["false_hits"])) for r in held], shards))

        @F.arrow_udf("array<boolean>")
        def dropped(hi: pa.Array, lo: pa.Array) -> pa.Array:
            flat_hi, flat_lo = hi.flatten(), lo.flatten()
            known = flat_hi.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(len(flat_hi), bool)
            out[known] = probe.value.holds(flat_hi.drop_null().to_numpy(), flat_lo.drop_null().to_numpy())
            sizes = np.diff(hi.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(out))

        flagged = rows.withColumn("__dropped", dropped("__hi", "__lo"))
        return flagged.withColumn("__kept", F.filter("__lines", lambda _, i: ~F.get(F.col("__dropped"), i)))

    def _by_join(self, rows: DataFrame) -> DataFrame:
        """The same by joins: distinct hashes of the lines of distinct texts, those counted often enough, back to the texts."""
        seeds = [F.xxhash64(F.lit(s), F.array_join("__lines", "\n")) for s in (1, 2)]
        named = rows.withColumns({"__t1": seeds[0], "__t2": seeds[1]})
        each = named.select("__t1", "__t2", F.posexplode(F.arrays_zip("__hi", "__lo")).alias("at", "key")).select("__t1", "__t2", "at", F.col("key.__hi").alias("hi"), F.col("key.__lo").alias("lo"))
        often = self.counts.where(F.col("docs") >= self.min_docs).select("hi", "lo")
        found = each.where("hi is not null").distinct().join(often, ["hi", "lo"], "left_semi")
        of_text = found.groupBy("__t1", "__t2").agg(F.collect_set("at").alias("__at"))
        places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce("__at", F.array().cast("array<int>")))
        joined = named.join(of_text, ["__t1", "__t2"], "left")
        return joined.withColumn("__kept", F.transform(places, lambda i: F.get("__lines", i)))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, folder: str | None = None) -> DataFrame:
    """``docs`` cleaned of their frequent lines through a new index over all of them, in ``folder`` (one of the shared folder)."""
    index = LineIndex(docs.sparkSession, folder or work_dir(docs.sparkSession), min_docs, min_chars)
    index.insert(docs, "all")
    return index.clean(docs)
