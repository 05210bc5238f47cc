"""Decontamination against SQL and by hand."""

import hashlib
import re

import pytest

from checks.run import compare, duck
from siftload.llm import decontaminate, queries

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, item_id long"


def brute(text, items, width):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        if not w:
            continue
        n = min(width, len(w))
        for s in range(len(w) - n + 1):
            for d in range(len(doc) - n + 1):
                if doc[d : d + n] == w[s : s + n]:
                    hit.update(range(d, d + n))
                    found.add(item)
    names = sorted(str(i) for i in found if i is not None)
    return len(doc), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


ITEMS = [(1, "one Two three four five"), (2, "four five"), (3, "..."), (4, None), (10, "four five"), (5, "solo"), (None, "null item words here now")]
TEXTS = [
    "ONE two, three four five six", "zero one two three", "five four. Five four five four five", "", None, "?!", "solo", "SOLO solo Ésolo",
    "null item words here now and four five", "x " * 500 + "two three four five " + "y " * 500,
]


@pytest.mark.parametrize("small", [True, False])
def test_by_hand(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(decontaminate, "MOST_BROADCAST_BYTES", -1)
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 8), (0, "solo", 9), (None, "solo", 9), (None, None, 9)]
    docs = spark.createDataFrame(rows, DOC)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    got = decontaminate.decontaminate(docs, items, 4).drop("text_hash").collect()
    key = lambda r: tuple(str(x) for x in r)
    want = [(i, *brute(t, ITEMS, 4)) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(none, spark.createDataFrame(ITEMS, "item_id long, text string"), 4).collect() == []
    got = decontaminate.decontaminate(spark.createDataFrame([(1, "a b", 1)], DOC), items, 4).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got] == [(2, 0, False)]


def test_against_sql(spark):
    problem, n = compare(duck(FOLDER), queries.ORACLE["op5_decontaminate"], queries.QUERIES["op5_decontaminate"](spark, FOLDER))
    assert problem is None and n > 0
