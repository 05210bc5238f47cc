"""The manifest against a plain one, with lone, small and large groups, many groups, nulls and repeated rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from siftload.llm import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp int, rank string"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(digests):
    """The top, and for each leaf its siblings before and after it, from the leaf up."""
    ways, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, place in enumerate(at):
            run = place // 16 * 16
            ways[i].append(("".join(digests[run:place]), "".join(digests[place + 1 : run + 16])))
        digests = [sha(*digests[i : i + 16]) for i in range(0, len(digests), 16)]
        at = [place // 16 for place in at]
    return digests[0] if digests else None, ways


def plain(rows):
    groups = {}
    for i, t, lang, source, n in rows:
        lower = None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        leaf = plain_leaf(i, t, lang, source, n)
        start = plain_leaf(i, lower, lang, source, n) if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else leaf
        groups.setdefault(source, []).append((i is not None, i or 0, leaf, start, i))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(groups[s], key=lambda r: r[:3])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (_, _, leaf, start, i), way in zip(sorted(groups[s], key=lambda r: r[:3]), trees[s][1], strict=True):
            got = start
            for before, after in way + top:
                got = sha(before, got, after)
            out.append((i, leaf, trees[s][0], root, sha(*[b + a for b, a in way + top]), got, got == root))
    return sorted(out, key=str)


def answer(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    out = merkle_manifest.verify_documents(df)
    assert out.columns == NAMES
    return sorted(map(tuple, out.collect()), key=str)


def made(n, source):
    return [(i * 7 % n, f"Text {i} É", "en" if i % 3 else None, source, i % 5 or None) for i in range(n)]


def test_many_groups_of_all_sizes(spark):
    rows = made(700, "big") + made(256, "exact") + made(17, "seventeen") + made(16, "") + made(2, None)
    rows += [(9_000_000 + i, f"T{i}", "de", f"s{i}é", i) for i in range(30)]
    rows += [(5, None, None, "é", None), (None, "A", "en", "é", 1), (None, "A", "en", "é", 1), (5, None, None, "é", None), (5, "", "en", "é", 0)]
    got = answer(spark, rows)
    assert got == plain(rows) and len(got) == len(rows)
    assert {r[6] for r in got} == {True, False}


def test_very_many_equal_rows_and_one_long_text(spark):
    rows = [(5, "same", "en", "hot", 4)] * 900 + [(None, "Long " * 100_000, "en", "hot", 1)]
    assert answer(spark, rows) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, "A", "en", "s", 1)], [(1, "A", "en", None, 1)], made(40, "only")])
def test_small_tables(spark, rows):
    got = answer(spark, rows)
    assert got == plain(rows)
    if len(rows) == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")


def test_store_and_single_requests(spark):
    rows = made(600, "a") + made(30, "b") + [(1, "t", "en", "c", 1)]
    manifest = merkle_manifest.build_manifest(merkle_manifest.document_leaves(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)))
    store = {r["digest"]: r["children"] for r in manifest.records().collect()}
    assert all(sha(*children) == digest for digest, children in store.items()) and len(store) == 38 + 3 + 1 + 2 + 1 + 1
    assert manifest.root() in store
    asked = spark.createDataFrame([("=a", 599), ("=a", 0), ("=b", 16), ("=c", 0), ("=c", 1), ("none", 0)], "grp string, rank long")
    few = manifest.proofs(asked).select("grp", "rank", merkle_manifest.proof_digest(F.col("path")).alias("p"), merkle_manifest.folded(F.col("digest"), F.col("path")).alias("f"))
    every = {(r["grp"], r["rank"]): r["p"] for r in manifest.proofs().select("grp", "rank", merkle_manifest.proof_digest(F.col("path")).alias("p")).collect()}
    found = few.collect()
    assert {(r["grp"], r["rank"]): r["p"] for r in found} == {k: every[k] for k in [("=a", 599), ("=a", 0), ("=b", 16), ("=c", 0)]}
    assert {r["f"] for r in found} == {manifest.root()}
