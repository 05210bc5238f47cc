"""Runs against all lags tried one by one, and the query against a plain version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from siftload.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, runs string"


def plain_runs(words, least=6, times=4):
    """Every lag by itself: maximal stretches of equal words, kept where no smaller lag has the same stretch."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, taken = np.array([numbers[w] for w in words], np.int64), {}
    for q in range(1, len(words) // times + 1):
        equal = np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int)
        edges = np.flatnonzero(np.diff(equal))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s + q >= max(least, times * q):
                taken.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in taken.items())


def found(texts, **how):
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers = {w: i for i, w in enumerate({w for t in words for w in t})}
    flat = np.array([numbers[w] for t in words for w in t], np.int64)
    s, n, q = periodic_runs.periodic_runs(flat, np.repeat(starts, sizes), **how)
    out = [[] for _ in texts]
    for a, b, c in zip(s.tolist(), n.tolist(), q.tolist(), strict=True):
        i = int(np.flatnonzero((starts <= a) & (a < starts + sizes))[0])
        out[i].append((a - int(starts[i]), b, c))
    return out


def test_random_texts():
    rng = random.Random(3)
    texts = []
    for _ in range(1500):
        word = lambda: rng.choice("ab" if rng.random() < 0.5 else "abcde")
        parts = [[word() for _ in range(rng.randint(0, 6))] * rng.choice([1, 1, 2, 4, 5, 9]) for _ in range(rng.randint(0, 6))]
        texts.append(" ".join(w for p in parts for w in p[: len(p) - rng.randint(0, 2)]))
    for least, times in ((6, 4), (1, 3), (20, 5)):
        assert found(texts, least=least, times=times) == [plain_runs(t.split(), least, times) for t in texts]


def test_long_periods_and_constant_words():
    base = [f"w{i % 611}x{i * i % 97}" for i in range(700)]
    texts = [" ".join(base * 4 + ["end"]), " ".join(["a"] * 20000), " ".join((["a"] * 50 + ["b"]) * 200), " ".join(base * 3), "", "a"]
    assert found(texts) == [plain_runs(t.split()) for t in texts]
    assert found(texts)[0] == [(0, 2800, 700)] and found(texts)[3] == []


def test_keys_that_do_not_fit_in_one_number():
    key = np.array([1 << 62, 5, 1 << 62, 5], np.int64)
    order, same = periodic_runs.equal_neighbours(key, np.arange(4))
    assert order.tolist() == [1, 3, 0, 2] and same.tolist() == [False, True, False, True]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(key, key, times=2)


def test_rows(spark):
    rows = [(1, "x a b a b a b a b y", "old"), (1, "x a b a b a b a b y", "old"), (None, None, None), (2, "", "z"), (3, " \t\n\x0b\x0c\r ", "z"), (4, "q q q q q q", "z"), (5, "a b c " * 5000, "z"), (6, "a\u00a0" * 9, "z")]
    out = periodic_runs.find_runs(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect())
    run = (1, 10, [(1, 8, 2)], "x a b y")
    assert got == [(0, 0, [], ""), run, run, (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "q"), (5, 15000, [(0, 15000, 3)], "a b c"), (6, 1, [], "a\u00a0" * 9)]
    assert periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_row(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], sha(lines), sha(kept))


def test_query_against_plain_version(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    made = [(10**6 + i, " ".join(random.Random(i).choices("ab c d é".split(" "), k=60))) for i in range(300)] + [(None, "a a a a a a a"), (7, None), (7, None), (8, "")]
    spark.createDataFrame(given + made, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_periodic_runs(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(str(plain_row(*r)) for r in given + made)
    assert sum(r["n_runs"] > 0 for r in out) > 30
