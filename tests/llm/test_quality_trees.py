"""Base figures against a plain version, and the trees' accuracy and monotony."""

import re
from collections import Counter

import numpy as np

from siftload.llm import quality_trees
from siftload.llm.common import importable, table

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)]


def test_base_figures(spark):
    importable(spark)
    odd = ["", None, " \n\t", "a a a a a", "a b c\na b c\n\na b c", "é ü\x0b# <|>", "x " * 4000, "one two three"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(odd + odd)], "doc_id long, text string, n_words int")
    trees = quality_trees.fit_trees(np.zeros((0, 13)), np.zeros(0), list(quality_trees.FEATURES.values()))
    got = {(r["doc_id"]): r for r in quality_trees.rate_quality(df, trees).collect()}
    for i, t in enumerate(odd + odd):
        assert [got[i][c] for c in quality_trees.BASE] == plain(t)
        n, _, _, _, repeat = plain(t)
        assert got[i]["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_empty(spark):
    importable(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_trees.rate_quality(docs, quality_trees.fit_quality(docs, labels)).collect() == []


def test_given_documents(spark):
    importable(spark)
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    even = labels.where("doc_id % 2 = 0")
    out = quality_trees.rate_quality(docs, quality_trees.fit_quality(docs, even)).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = np.mean([r["kept"] == bool(r["quality"] if False else r[labels.columns.index("quality") - len(labels.columns)]) or r["base_failed"] for r in out])
    assert right > 0.85
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all([r[c] for c in quality_trees.BASE] == plain(texts[r["doc_id"]]) for r in out)


def test_constraints_hold():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 3))
    y = (np.sin(6 * x[:, 0]) + x[:, 1] + 0.3 * rng.standard_normal(3000) > 1).astype(float)
    trees = quality_trees.fit_trees(x, y, [1, -1, 0], trees=30)
    for feature, sign in ((0, 1), (1, -1)):
        for _ in range(50):
            line = np.repeat(rng.random((1, 3)), 60, 0)
            line[:, feature] = np.linspace(0, 1, 60)
            assert (sign * np.diff(trees.probability(line)) >= -1e-12).all()
    free = quality_trees.fit_trees(x, y, [0, 0, 0], trees=30)
    assert ((free.probability(x) > 0.5) == y).mean() > 0.85


def test_the_bound_ignores_label_and_features(spark):
    """One labelled id with very many texts: the cut takes texts by hash, so both labels keep their shares."""
    rows = [(3, "good " * (i % 90 + 5) + str(i)) for i in range(600)] + [(1000 + i, "#" * (i + 1)) for i in range(600)] + [(1, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "int(doc_id < 1000) AS quality", "0 AS toxic")
    sample = quality_trees.labelled_sample(docs, labels, "quality", 200).collect()
    assert len(sample) == 200 and 60 <= sum(r["y"] for r in sample) <= 140
    assert len({r["text"] for r in quality_trees.labelled_sample(docs, labels, "quality", 5000).collect()}) == 1201
