"""Token ids in binary shard files, with a minimal perfect hash index from document keys to places in the shards.

A shard file is a head, the raw ids of its documents one after the other, and the documents' lengths:

    head     8 bytes mark, then bytes per id, documents and ids as little-endian 64-bit integers
    payload  ids, little-endian, 2 bytes each if the vocabulary fits, else 4
    lengths  ids of each document, little-endian 32-bit

The index is cut into buckets by key hash. A bucket holds bit levels that send each of its n keys to a number of its own
from 0 to n-1 without storing keys, and there a fingerprint, the shard, the first document in it, the number of
documents, the offset and the number of ids. A read is one hash, a few bit probes, one comparison and one seek.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftload.llm.common import text_runs
from siftload.session import work_dir

MARK = b"SLIDS001"
HEAD = 32
# Ids after which a writer starts a new file, and keys in one bucket of the index on average.
IDS_PER_FILE = 16 << 20
KEYS_PER_BUCKET = 8192
# Bits of a level for each key it has to place.
BITS_PER_KEY = 2
# Words whose ids a Python worker keeps: so many new ones, and as many from before. Longer words are never kept, which
# bounds the bytes: scripts without blanks make a word of a whole text.
MOST_KEPT = 1 << 19
LONGEST_KEPT = 48
# Marks that end a word of letters or digits and are split from it by the tokenizer.
# The pattern begins with them, since a search for one of a few characters is quick.
ENDING = re.compile(r'[.,;:!?|#$%&*()"-](?<=[^\W_].)[.,;:!?|#$%&*()"-]*(?=\s|$)')
# The key under which documents with a null id are found.
NULL_KEY = -(1 << 63)


# ---------------------------------------------------------------- encoding


class WordEncoder(dict):
    """Ids of texts under a tokenizer that drops blanks, word by word; a word's ids are worked out once while it is kept.

    Such a tokenizer never looks across blanks, so a text's ids are those of its words in a row. Latin letters go
    straight to the model; marks at a word's end are words of their own; every other word goes through the whole
    tokenizer. When the kept words are too many, those not asked for since the last such moment are forgotten.
    """

    def __init__(self, tokenizer_file: str, dtype: str, most_kept: int = MOST_KEPT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _drops_blanks(spec)
        self.code = "H" if dtype == "<u2" else "I"
        self.most_kept = most_kept
        self.before: dict[str, bytes] = {}
        marks = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in marks} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in marks)}
        self.shown = str.maketrans({chr(b): c for b, c in shown.items()})
        self.latin = re.compile("[A-Za-zÀ-ÖØ-öø-į]+").fullmatch

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def full(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def letters(self, word: str) -> bytes:
        shown = word.lower()
        if not word.isascii():
            shown = shown.encode().decode("latin-1").translate(self.shown)
        return self.packed([t.id for t in self.model.tokenize(shown)])

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.letters(word) if self.latin(word) else self.full(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.most_kept:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        # Python's blanks and the tokenizer's are the same but for these separators.
        if not self.by_word or re.search("[\x1c-\x1f]", text):
            return self.full(text)
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.__getitem__, ENDING.sub(r" \g<0>", text).split()))


def _drops_blanks(spec: dict) -> bool:
    """Whether the file is of the kind above: lower case, words split by a pattern without blanks, byte-level marks."""
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = next((s for s in steps if s["type"] == "Split"), None)
    level = next((s for s in steps if s["type"] == "ByteLevel"), None)
    return bool(
        kinds == ["NFC", "Replace", "Lowercase"]
        and split and split["behavior"] == "Removed" and split["invert"] and r"[\p{L}]+" in split["pattern"]["Regex"]
        and level and not level["add_prefix_space"] and not level["use_regex"]
        and spec["model"].get("end_of_word_suffix")
    )


def id_type(tokenizer_file: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(with_added_tokens=True) - 1, end_id)
    return "<u2" if largest < 1 << 16 else "<u4"


# ---------------------------------------------------------------- shard files


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The shared folder's file system as Arrow has it (local, S3, GCS, HDFS)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class ShardWriter:
    """Writes one task's documents to files with names of its own, so a repeated task never meets another's files."""

    def __init__(self, folder: str, partition: int, dtype: str, ids_per_file: int):
        self.fs, self.root = file_system(folder)
        self.partition, self.dtype, self.ids_per_file = partition, np.dtype(dtype), ids_per_file
        self.attempt = uuid.uuid4().hex
        self.count = 0
        self.out = None

    def open(self) -> None:
        self.name = f"part-{self.partition:06d}-{self.count:04d}-{self.attempt}.ids"
        self.out = self.fs.open_output_stream(f"{self.root}/{self.name}")
        # Documents and ids stand at the end, too: the head is written before they are known.
        self.out.write(MARK + self.dtype.itemsize.to_bytes(8, "little") + bytes(HEAD - 16))
        self.lengths: list[int] = []
        self.ids = 0

    def add(self, payload: bytes) -> tuple[str, int, int]:
        """(file, document in it, offset in ids) of the document just written."""
        if self.out is None:
            self.open()
        place = (self.name, len(self.lengths), self.ids)
        self.out.write(payload)
        n = len(payload) // self.dtype.itemsize
        self.lengths.append(n)
        self.ids += n
        if self.ids >= self.ids_per_file:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.write(np.array(self.lengths, "<u4").tobytes())
            self.out.write(len(self.lengths).to_bytes(8, "little") + self.ids.to_bytes(8, "little"))
            self.out.close()
            self.out, self.count = None, self.count + 1


class ShardReader:
    """Reads ids of single documents, or of runs of documents, by place."""

    def __init__(self, folder: str):
        self.fs, self.root = file_system(folder)
        self.name = None

    def open(self, name: str) -> None:
        if name != self.name:
            self.name, self.file = name, self.fs.open_input_file(f"{self.root}/{name}")
            head = self.file.read_at(16, 0)
            if head[:8] != MARK:
                raise ValueError(f"{name} is no shard file")
            self.width = int.from_bytes(head[8:16], "little")
            size = self.file.size()
            end = self.file.read_at(16, size - 16)
            self.documents, self.ids = int.from_bytes(end[:8], "little"), int.from_bytes(end[8:], "little")
            self.lengths_at = HEAD + self.ids * self.width

    def read(self, name: str, first: int, documents: int, offset: int, n: int) -> list[np.ndarray]:
        self.open(name)
        ids = np.frombuffer(self.file.read_at(n * self.width, HEAD + offset * self.width), f"<u{self.width}")
        if documents == 1:
            return [ids]
        lengths = np.frombuffer(self.file.read_at(4 * documents, self.lengths_at + 4 * first), "<u4")
        return np.split(ids, np.cumsum(lengths)[:-1])


_encoders: dict[tuple[str, str], WordEncoder] = {}


def write_shards(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Encodes and writes all documents in ascending doc_id order; returns the places: key, shard, first, documents, offset, ids.

    Documents are dealt by ranges of their id, and each task writes its range in order, a new file every
    ``ids_per_file`` ids. Equal ids go by the beginning and hash of their texts, equal rows are dealt at random, so that an
    id with very many rows is spread over tasks; it is one entry per file, with the number of its documents. A task that is
    run again writes files of its own. What counts is what the returned rows name; files of tasks that were lost are named
    by none.
    """
    dtype = id_type(tokenizer_file, end_id)
    end = np.array([end_id], dtype).tobytes()
    width = np.dtype(dtype).itemsize
    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoders.setdefault((tokenizer_file, dtype), WordEncoder(tokenizer_file, dtype))
        out = ShardWriter(folder, TaskContext.get().partitionId(), dtype, ids_per_file)
        entry = None  # of the last key: key, shard, first, documents, offset, ids
        for batch in text_runs(batches, "text", 1 << 20):
            done = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                payload = encoder.encode(text) + end
                name, first, offset = out.add(payload)
                n = len(payload) // width
                if entry and entry[0] == key and entry[1] == name:
                    entry[3] += 1
                    entry[5] += n
                else:
                    if entry:
                        done.append(entry)
                    entry = [key, name, first, 1, offset, n]
            if done:
                yield _places(done)
        out.close()
        if entry:
            yield _places([entry])

    order = ["key", F.substring("text", 1, 32), F.xxhash64("text")]
    ranged = docs.select(key.alias("key"), "text").repartitionByRange(*[F.col("key"), *order[1:], F.rand(7)]).sortWithinPartitions(*order)
    return ranged.mapInArrow(write, "key long, shard string, first long, documents long, offset long, ids long")


def _places(rows: list[list]) -> pa.RecordBatch:
    names = ["key", "shard", "first", "documents", "offset", "ids"]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


# ---------------------------------------------------------------- minimal perfect hash


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key (the finalizer of splitmix64)."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return mixed(keys, 1_000_003).astype("<u4")


@dataclass
class PerfectHash:
    """Levels of bits; a key's number is the count of set bits before its own."""

    levels: list[np.ndarray]

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct. Each level keeps the keys that are alone at their bit and passes the others on."""
        levels = []
        while len(keys):
            at = mixed(keys, len(levels)) % np.uint64(BITS_PER_KEY * len(keys))
            counts = np.bincount(at.astype(np.int64), minlength=BITS_PER_KEY * len(keys))
            levels.append(counts == 1)
            keys = keys[counts[at.astype(np.int64)] > 1]
        return PerfectHash(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """0 to n-1 for each key it was built from; for others any number, or -1. The fingerprint tells them apart."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for seed, bits in enumerate(self.levels):
            at = (mixed(keys[left], seed) % np.uint64(len(bits))).astype(np.int64)
            before = np.cumsum(bits) - bits
            found = bits[at]
            out[left[found]] = base + before[at[found]]
            left, base = left[~found], base + int(bits.sum())
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @staticmethod
    def from_bytes(raw: bytes) -> PerfectHash:
        n = int.from_bytes(raw[:4], "little")
        sizes, at, levels = np.frombuffer(raw, "<u4", n, 4), 4 + 4 * n, []
        for size in sizes.tolist():
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return PerfectHash(levels)


# ---------------------------------------------------------------- index


def bucket_of(key: F.Column, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def build_index(places: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: bucket, levels (the hash), prints, starts (where a number's entries begin) and entries.

    A key has an entry for every file it stands in, one in almost all cases.
    """
    schema = "bucket int, levels binary, prints binary, starts binary, shards array<string>, entries binary"

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "shard", "first"])
        keys = frame["key"].to_numpy(np.int64)
        distinct = np.unique(keys)
        hashed = PerfectHash.build(distinct)
        number = hashed.number(keys)
        order = np.argsort(number, kind="stable")
        prints = np.zeros(len(distinct), "<u4")
        prints[number] = fingerprints(keys)
        starts = np.searchsorted(number[order], np.arange(len(distinct) + 1)).astype("<u4")
        shards, which = np.unique(frame["shard"].to_numpy(str), return_inverse=True)
        entries = np.stack([which, *(frame[c].to_numpy(np.int64) for c in ("first", "documents", "offset", "ids"))], 1)[order]
        row = [int(frame["bucket"].iloc[0]), hashed.to_bytes(), prints.tobytes(), starts.tobytes(), shards.tolist(), entries.astype("<i8").tobytes()]
        return pd.DataFrame([row], columns=["bucket", "levels", "prints", "starts", "shards", "entries"])

    return places.withColumn("bucket", bucket_of(F.col("key"), buckets)).groupBy("bucket").applyInPandas(build, schema)


def look_up(index: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """Places of the distinct ``keys`` (key): key, shard, first, documents, offset, ids. Unknown keys have none."""
    schema = "key long, shard string, first long, documents long, offset long, ids long"
    names = ["key", "shard", "first", "documents", "offset", "ids"]

    def probe(wanted: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted) or not len(held):
            return pd.DataFrame({c: pd.Series(dtype=str if c == "shard" else np.int64) for c in names})
        row = held.iloc[0]
        keys = wanted["key"].to_numpy(np.int64)
        prints, starts = np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["starts"], "<u4").astype(np.int64)
        entries = np.frombuffer(row["entries"], "<i8").reshape(-1, 5)
        number = PerfectHash.from_bytes(row["levels"]).number(keys)
        known = number >= 0
        known[known] = prints[number[known]] == fingerprints(keys[known])
        keys, number = keys[known], number[known]
        counts = starts[number + 1] - starts[number]
        at = np.repeat(starts[number] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        found = entries[at]
        shards = np.array(list(row["shards"]), dtype=object)[found[:, 0]]
        return pd.DataFrame(dict(zip(names, [np.repeat(keys, counts), shards, *found[:, 1:].T], strict=True)))

    wanted = keys.select("key").distinct().withColumn("bucket", bucket_of(F.col("key"), buckets))
    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, schema)


def read_ids(places: DataFrame, folder: str, digest_only: bool = False) -> DataFrame:
    """Reads the documents at ``places``: key, shard, offset (ids before it in its shard), n_tokens, ids_crc32, and ids
    (array of int) unless only the digest is wanted. Places are sorted by shard, so each task reads its files in a row."""
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

    schema = StructType()
    for name, kind in (("key", LongType()), ("shard", StringType()), ("offset", LongType()), ("n_tokens", LongType()), ("ids_crc32", LongType())):
        schema = schema.add(name, kind)
    if not digest_only:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(folder)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for place in batch.to_pylist():
                offset = place["offset"]
                for ids in reader.read(place["shard"], place["first"], place["documents"], offset, place["ids"]):
                    wide = ids.astype("<u4")
                    rows.append((place["key"], place["shard"], offset, len(ids), zlib.crc32(wide.tobytes()), *(() if digest_only else (wide.view("<i4"),))))
                    offset += len(ids)
                    held += 0 if digest_only else len(ids)
                    if held > 1 << 20:
                        yield _rows(rows, schema.names)
                        rows, held = [], 0
            if rows:
                yield _rows(rows, schema.names)

    return places.repartition("shard").sortWithinPartitions("shard", "first").mapInArrow(read, schema)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = dict(zip(("key", "shard", "offset", "n_tokens", "ids_crc32", "ids"), (pa.int64(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int32())), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[n]) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


@dataclass
class TokenShards:
    """A written collection: the folder of its files, their places and the index over them."""

    spark: SparkSession
    folder: str
    buckets: int

    @property
    def places(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/places")

    @property
    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/index")

    def fetch(self, keys: DataFrame, digest_only: bool = False) -> DataFrame:
        """Documents of ``keys`` (key), found through the index and read from the files."""
        return read_ids(look_up(self.index, keys, self.buckets), f"{self.folder}/shards", digest_only)

    def shard_starts(self) -> DataFrame:
        """shard and start: ids in all shards before it. Names sort as the documents do; one row per file."""
        sizes = self.places.groupBy("shard").agg(F.sum("ids").alias("ids"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))


def write_token_shards(
    docs: DataFrame, tokenizer_file: str, end_id: int = 1, folder: str | None = None, ids_per_file: int = IDS_PER_FILE
) -> TokenShards:
    """Writes shard files and index for ``docs`` (doc_id, text) below ``folder`` (a new one in the shared folder by default).

    A null text has its end id only. Documents with a null doc_id come first and are found under NULL_KEY (the smallest
    long, which no other document may have). Repeated rows are all written. Without documents the index is empty.
    Extra columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark)
    write_shards(docs, f"{folder}/shards", tokenizer_file, end_id, ids_per_file).write.parquet(f"{folder}/places")
    places = spark.read.parquet(f"{folder}/places")
    buckets = max(1, -(-places.count() // KEYS_PER_BUCKET))
    build_index(places, buckets).write.parquet(f"{folder}/index")
    return TokenShards(spark, folder, buckets)


def token_digests(docs: DataFrame, tokenizer_file: str, end_id: int = 1) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document row, from the files it writes and reads back by key."""
    shards = write_token_shards(docs, tokenizer_file, end_id)
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"))
    read = shards.fetch(keys, digest_only=True).join(shards.shard_starts(), "shard")
    return read.select(
        F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
