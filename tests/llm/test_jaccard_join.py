"""The join against all pairs, on texts made to lie near the limit."""

import random

import numpy as np
import pytest

from siftload.llm import jaccard_join


def shingles(text, k):
    w = (text or "").split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 60, 90]))) for _ in range(12)]
    out = []
    for i in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"n{rng.randrange(9000)}"] if rng.random() < 0.7 else []
        out.append((i, " ".join(words)))
    return out


def run(spark, rows, k=4, percent=85):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS component_id")
    got = jaccard_join.jaccard_components(df, k, percent).drop("text_hash", "component").collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("group_sets", [4096, 8])
def test_near_the_limit_and_odd_rows(spark, monkeypatch, group_sets):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", group_sets)
    rows = texts(1, 260)
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "One"), (905, "one two"), (None, rows[3][1]), (None, None), (None, "alone here"), rows[5], rows[5]]
    lower = [(d, t.lower() if t else t) for d, t in rows]
    assert run(spark, rows) == brute(lower, 4, 85)


def test_other_limits(spark):
    rows = texts(2, 120)
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_empty(spark):
    assert run(spark, []) == []


def test_links_in_tile_match_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(20):
        base = rng.integers(0, 400, 60).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(60) > 0.06], rng.integers(1000, 9000, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(40)]
        groups = {i: {i} for i in range(40)}
        for i in range(40):
            for j in range(i):
                inter = len(np.intersect1d(sets[i], sets[j]))
                if 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter) and groups[i] is not groups[j]:
                    both = groups[i] | groups[j]
                    groups.update(dict.fromkeys(both, both))
        got = {i: {i} for i in range(40)}
        for i, j in jaccard_join.links_in_tile(sets, 85):
            both = got[i] | got[j]
            got.update(dict.fromkeys(both, both))
        assert got == groups


def test_bitmaps_never_part_a_linked_pair():
    rng = np.random.default_rng(8)
    for _ in range(30):
        base = rng.integers(0, 1 << 62, 700).astype(np.uint64)
        sets = sorted((np.unique(np.concatenate([base[: rng.integers(40, 700)], rng.integers(0, 1 << 62, rng.integers(0, 9)).astype(np.uint64)])) for _ in range(40)), key=len)
        sizes = np.array([len(s) for s in sets])
        joined = {i: i for i in range(40)}

        def root(i, joined=joined):
            while joined[i] != i:
                i = joined[i]
            return i

        for i, j in jaccard_join.may_link(sizes, [jaccard_join.bitmap(s) for s in sets], 85):
            joined[root(i)] = root(j)
        for i in range(40):
            for j in range(i):
                inter = len(np.intersect1d(sets[i], sets[j]))
                if 100 * inter >= 85 * (sizes[i] + sizes[j] - inter):
                    assert root(i) == root(j)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    got = {r["node"]: r["root"] for r in jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000, 1002: 1000}


def test_similarities_that_bitmaps_cannot_bound_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    with pytest.raises(ValueError):
        jaccard_join.jaccard_components(docs, 4, 49)
