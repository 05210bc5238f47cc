"""Sharding by jump consistent hashing (Lamping and Veach): no ring table, and one more shard takes rows only into itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftload.llm.common import utf8_crc32
from siftload.sources.staging import staged

# The published generator (64 bits, state * MULTIPLIER + 1) and the part of it that a jump reads.
MULTIPLIER = 2862933555777941757
LOW_32 = 0xFFFFFFFF
# A jump at least doubles the shard on average, so few keys take more jumps than this; those take the long way.
USUAL_JUMPS = 64


def _low(c: Column, bits: int = 32) -> Column:
    return c.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's next state. Products of 32 and 16 bits never leave a long, so this holds in ANSI mode, too."""
    m = [F.lit(MULTIPLIER >> shift & 0xFFFF).cast("long") for shift in (0, 16, 32, 48)]
    low = lo * m[0] + F.lit(1) + F.shiftleft(_low(lo * m[1], 16), 16)
    carry = F.shiftright(low, 32) + F.shiftright(lo * m[1], 16)
    high = carry + hi * m[0] + F.shiftleft(_low(hi * m[1], 16), 16) + lo * m[2] + F.shiftleft(_low(lo * m[3], 16), 16)
    return _low(high), _low(low)


def key_bits(df: DataFrame, key: str) -> Column:
    """Whole numbers are their own 64 bits; other keys and null are hashed."""
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    hashed = F.xxhash64(F.col(key))
    return F.coalesce(F.col(key).cast("long"), hashed) if whole else hashed


def jump_shard(bits: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of 64 key bits."""
    if shards < 1:
        raise ValueError("there must be a shard")

    def jumps(most: int, finish) -> Column:
        start = F.struct(
            _low(F.shiftright(bits, 32)).alias("hi"), _low(bits).alias("lo"),
            F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"),
        )

        def jump(s: Column, _: Column) -> Column:
            hi, lo = _step(s["hi"], s["lo"])
            reach = (s["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double"))
            moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["next"].alias("at"), F.floor(reach).cast("long").alias("next"))
            return F.when(s["next"] >= shards, s).otherwise(moved)

        return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, jump, finish)

    if shards <= USUAL_JUMPS:
        return jumps(shards, lambda s: s["at"].cast("int"))
    soon = jumps(USUAL_JUMPS, lambda s: F.when(s["next"] >= shards, s["at"].cast("int")))
    return F.coalesce(soon, jumps(shards, lambda s: s["at"].cast("int")))


def first_draw(bits: Column) -> Column:
    """The generator's first 31 bits for a key; its low bits tell nothing about the shard."""
    return F.shiftright(_step(_low(F.shiftright(bits, 32)), _low(bits))[0], 1)


def assign_shards(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """Adds the shard of each row. Equal keys, null among them, share a shard."""
    return df.withColumn(out, jump_shard(key_bits(df, key), shards))


def shard_documents(docs: DataFrame, shards: int = 24, slices: int = 256) -> DataFrame:
    """Shard and gapless slot of every document, from its key and the shard count alone.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law, shard, slot, grown_shard (with one more
    shard). A null text has size 8 and the crc of empty text; a null doc_id is hashed like any key. Equal rows are
    counted before they are dealt out and get slots of their own. Extra columns are not read.

    A shard is numbered in ``slices`` parts, so that no task holds a whole shard: the slots of a part start where the
    counts of the parts before it end. Parts come from the key and the text, so one key with many texts is split.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        utf8_crc32(F.col("text")).alias("text_crc32"),
    )
    bits = key_bits(rows, "doc_id")
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    dealt = staged(
        counted.select(
            "*",
            jump_shard(bits, shards).alias("shard"),
            jump_shard(bits, shards + 1).alias("grown_shard"),
            ((first_draw(bits) + F.col("text_crc32")) % slices).cast("int").alias("slice"),
        )
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "slice").agg(F.sum("copies").alias("n")).select(
        "shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    earlier = Window.partitionBy("shard", "slice").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("earlier", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    first = F.col("start") + F.col("earlier")
    return placed.join(starts, ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
