"""Segments against all segments, and accuracy on held-out rows."""

import zlib

import numpy as np

from siftload.llm import toxic_segments
from siftload.llm.common import importable, table


def plain_segments(scores):
    """Best segment (first and shortest on ties), then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, _ = best
    right = [(a + j, b + j, s) for a, b, s in plain_segments(scores[j:])]
    return [*plain_segments(scores[:i]), best, *right]


def test_maximal_segments():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 30, 60):
        for _ in range(40):
            scores = np.where(rng.random(n) < 0.3, rng.random(n) * 3, -rng.random(n))
            got = toxic_segments.maximal_segments(scores)
            want = plain_segments(scores.tolist())
            assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
            assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_odd_rows(spark):
    importable(spark)
    rows = [(i, f"plain good words here number {i}", None) for i in range(120)]
    rows += [(200 + i, f"you vilefoo and vilebar words number {i}", None) for i in range(60)]
    docs = spark.createDataFrame([*rows, (500, None, 1.0), (501, "", 1.0), (None, "vilebaz vilequx", 1.0), (502, "vilezot " * 20_000, 1.0), (0, "twice", 1.0)], "doc_id long, text string, toxicity double")
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i, _, _ in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = {(r["doc_id"], r["text"]): r for r in toxic_segments.score_toxicity(docs, toxic_segments.fit_toxicity(docs, labels)).collect()}
    assert len(out) == docs.count()
    for (doc_id, text), r in out.items():
        assert 0 <= r["toxicity"] <= 1
        assert (r["toxicity"] >= 0.3) == ("vile" in (text or "")), (doc_id, r["toxicity"])
        assert bool(r["toxic_segments"]) == ("vile" in (text or ""))


def test_without_labels_nothing_is_toxic(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxic_segments.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r["toxicity"] < 0.01 for r in toxic_segments.score_toxicity(docs, model).collect()] == [True, True]
    assert toxic_segments.score_toxicity(docs.where("false"), model).collect() == []


def test_the_bound_holds_where_a_labelled_id_repeats(spark):
    importable(spark)
    rows = [(3, f"calm words of one id number {i}") for i in range(400)] + [(1000 + i, f"plain good words here number {i}") for i in range(120)]
    rows += [(2000 + i, f"you vilefoo and vilebar words number {i}") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "1 AS quality", "int(doc_id >= 2000) AS toxic")
    most = 200
    sample = toxic_segments.learning_rows(docs, labels, most).collect()
    assert len(sample) == most
    # About 520 clean texts and three quarters of the 160 toxic ones are labelled and not held out.
    assert 20 <= sum(r["toxic"] for r in sample) <= 60
    out = toxic_segments.score_toxicity(docs, toxic_segments.fit_toxicity(docs, labels, most)).collect()
    assert [r for r in out if (r["toxicity"] >= 0.3) != ("vile" in r["text"])] == []


def test_held_out_accuracy(spark):
    importable(spark)
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxic_segments.fit_toxicity(docs, labels)
    rows = toxic_segments.score_toxicity(docs.join(labels.select("doc_id", "toxic"), "doc_id"), model).select("doc_id", "toxic", "toxicity").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    hit = sum(r["toxic"] == 1 and r["toxicity"] >= 0.3 for r in held)
    called = sum(r["toxicity"] >= 0.3 for r in held)
    assert hit / called > 0.9 and hit / sum(r["toxic"] for r in held) > 0.8


def test_entries_left_out_are_counted_and_null_ids_are_not_held_out(spark):
    importable(spark)
    rows = [(i, f"plain good words here number {i}") for i in range(120)] + [(200 + i, f"you vilefoo and vilebar words number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "int(doc_id >= 200) AS toxic")
    whole, cut = toxic_segments.fit_toxicity(docs, labels), toxic_segments.fit_toxicity(docs, labels, most_entries=3)
    assert whole.left_out == 0 and len(cut.scores) == 3 and cut.left_out == len(whole.scores) - 3 > 0
    held = spark.createDataFrame([(None,), (1,)], "doc_id long").select(toxic_segments.held_out().alias("h")).collect()
    assert held[0]["h"] is False and held[1]["h"] == (zlib.crc32(b"1") % 4 == 2)
