"""Jump hashing against the published values and a plain version."""

import zlib

from pyspark.sql import functions as F

from siftload.llm import jump_shards

SCHEMA = "doc_id long, text string, size string"


def plain_jump(key: int, shards: int) -> int:
    b, j, key = -1, 0, key % (1 << 64)
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_known_values(spark):
    known = [(1, 1, 0), (42, 57, 43), (0xDEAD10CC, 1, 0), (0xDEAD10CC, 666, 361), (256, 1024, 520), (0, -10 + 11, 0)]
    for key, shards, shard in known:
        row = spark.range(1).select(jump_shards.jump_shard(F.lit(key).cast("long"), shards).alias("s")).first()
        assert row["s"] == shard == plain_jump(key, shards)


def test_many_keys_and_growth(spark):
    keys = [*range(-50, 50), -(1 << 63), (1 << 63) - 1, *(k * 7919 for k in range(900))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = df.select("k", *[jump_shards.jump_shard(F.col("k"), n).alias(f"s{n}") for n in (2, 24, 25, 300)]).collect()
    for r in rows:
        assert [r["s2"], r["s24"], r["s25"], r["s300"]] == [plain_jump(r["k"], n) for n in (2, 24, 25, 300)]
        assert r["s25"] in (r["s24"], 24)


def test_documents(spark):
    rows = [(i, f"text {i}", "x") for i in range(300)] + [(7, "text 7", "x"), (7, "other", None), (None, None, None), (None, "", None), (9, None, None), (9, None, None)]
    out = jump_shards.shard_documents(spark.createDataFrame(rows, SCHEMA), 24, slices=8).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
        if r["doc_id"] is not None:
            assert r["shard"] == plain_jump(r["doc_id"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None)
    want = sorted((False, i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    assert got == want


def test_empty(spark):
    assert jump_shards.shard_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_string_keys_keep_their_shard(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    rows = jump_shards.assign_shards(df, "k", 7).collect()
    assert len({r["shard"] for r in rows if r["k"] == "a"}) == 1
    assert all(0 <= r["shard"] < 7 for r in rows)
