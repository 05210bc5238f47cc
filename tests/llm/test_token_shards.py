"""Shard files against the tokenizer itself, and the index by itself."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from siftload.llm import token_shards
from siftload.llm.common import importable

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string"
TEXTS = [
    "Plain words, here.", "", None, "ÉÀ é ñ straße İstanbul ΣΑΣ", "it's  we'll\t\n\x0b don't", "a\x1cb\x1dc", "x<|endoftext|>y <|startoftext|>", "é é",
    "12 345 6,7 a1b2", "漢字 かな 🙂🙂", " nbsp wide　x\u0085y", "((..)) a.b.c rent,;", "word" * 300, "’quote’ – dash",
]


def expected(rows, end=1):
    tokenizer = Tokenizer.from_file(FILE)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_digests(spark):
    importable(spark)
    rows = [(i * 3, t, "k") for i, t in enumerate(TEXTS)] + [(3, "repeated", "k"), (3, "repeated", "k"), (None, "no id", None), (-5, "below", None)]
    got = token_shards.token_digests(spark.createDataFrame(rows, SCHEMA).repartition(3), FILE).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected([r[:2] for r in rows])


def test_small_files_and_single_reads(spark):
    importable(spark)
    rows = [(i, f"text number {i} " * (i % 7), "k") for i in range(400)] + [(8, "again", "k")]
    shards = token_shards.write_token_shards(spark.createDataFrame(rows, SCHEMA), FILE, ids_per_file=64)
    assert shards.places.select("shard").distinct().count() > 5
    keys = spark.createDataFrame([(8,), (399,), (8,), (12345,), (0,)], "key long")
    got = shards.fetch(keys).collect()
    tokenizer = Tokenizer.from_file(FILE)
    want = sorted((i, tokenizer.encode(t, add_special_tokens=False).ids + [1]) for i, t, _ in rows if i in (0, 8, 399))
    assert sorted((r["key"], r["ids"]) for r in got) == want


def test_one_id_with_a_third_of_the_rows(spark):
    """Its rows, many of them equal, are spread over files, and all are found under the one key."""
    importable(spark)
    rows = [(7, "the same text", "k")] * 300 + [(7, f"own text {i}", "k") for i in range(100)] + [(i, f"t {i}", "k") for i in range(800)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_shards.write_token_shards(frame, FILE)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shards.places.where("key = 7").select("shard").distinct().count() > 2
    assert shards.fetch(spark.createDataFrame([(7,)], "key long")).count() == 401
    got = sorted(map(tuple, token_shards.token_digests(frame, FILE).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(r[0] for r in rows) and got[-1][1] + got[-1][2] == sum(r[2] for r in got)
    assert sorted((r[0], *r[2:]) for r in got) == sorted((r[0], *r[2:]) for r in expected([r[:2] for r in rows]))


def test_forgotten_words_and_long_words():
    tokenizer = Tokenizer.from_file(FILE)
    encoder = token_shards.WordEncoder(FILE, "<u2", most_kept=5)
    for text in ["one two, three. four five six seven", "one two three, 4.0. (eight) nine-ten", "x" * 5000 + ", " + "é" * 200, "one 'quoted'. ½, Ⅷ. é́, ”,"] * 3:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder) <= 5 and len(encoder.before) <= 5 and max(map(len, encoder)) <= token_shards.LONGEST_KEPT


def test_empty(spark):
    importable(spark)
    assert token_shards.token_digests(spark.createDataFrame([], SCHEMA), FILE).collect() == []


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 20_000):
        keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64)
        built = token_shards.PerfectHash.from_bytes(token_shards.PerfectHash.build(keys).to_bytes())
        assert sorted(built.number(keys).tolist()) == list(range(n))


def test_words_give_the_whole_text():
    tokenizer = Tokenizer.from_file(FILE)
    encoder = token_shards.WordEncoder(FILE, "<u2")
    for text in TEXTS:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
