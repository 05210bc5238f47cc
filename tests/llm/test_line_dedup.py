"""The line index against plain counting, forwards and backwards, and its filters by themselves."""

import random
from collections import Counter

import numpy as np
import pytest

from siftload.llm import line_dedup
from siftload.llm.line_dedup import CuckooFilter, LineIndex, Probe, updated_filter

SCHEMA = "doc_id long, text string, kept string"
BLANKS = " \t\x0b\x0c\r"


def key(line):
    line = line.strip(BLANKS)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def plain(held, asked, min_docs, min_chars=1):
    """(doc_id, n_lines, n_dropped, kept) of the asked documents where the held ones are counted."""
    docs = Counter(k for _, t in held for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in asked:
        lines = (t or "").split("\n")
        kept = [x for x in lines if docs[key(x)] < min_docs or len(key(x)) < min_chars]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "old") for i, t in rows], SCHEMA)


def answer(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=str)


def made(n, seed, first=0):
    rng = random.Random(seed)
    pool = [f"Line {i}" for i in range(40)] + ["", " ", " ", "Ärger", "ärger", "x" * 300]
    return [(first + i, "\n".join(rng.choice((str.upper, str.lower, lambda x: f" {x}\t"))(rng.choice(pool)) for _ in range(rng.randint(0, 12)))) for i in range(n)]


def test_filters_hold_what_went_in():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(1 << 63), (1 << 63) - 1, (2, 5000))
    made = CuckooFilter.sized_for(5000)
    assert made.insert(hi, lo) and made.holds(hi, lo).all()
    made.delete(hi[:2000], lo[:2000])
    assert made.holds(hi[2000:], lo[2000:]).all() and made.holds(hi[:2000], lo[:2000]).sum() < 10
    again = CuckooFilter.from_bytes(made.to_bytes())
    assert (again.slots == made.slots).all()
    made.delete(hi[2000:], lo[2000:])
    assert not made.slots.any()
    full = CuckooFilter(np.zeros((2, 4), np.uint16))
    assert not full.insert(hi[:9], lo[:9])


def test_equal_marks_need_a_larger_filter_and_false_hits_are_named():
    rng = np.random.default_rng(2)
    hi = np.repeat(rng.integers(0, 1 << 40, 4), 30)
    lo = rng.integers(-(1 << 63), (1 << 63) - 1, 120)
    docs = np.where(np.arange(120) % 3 == 0, 10, 9)
    table, false = updated_filter(None, hi, lo, np.zeros(120, np.int64), docs, 10)
    probe = Probe.of([(0, table, false)], 1)
    assert len(false) > 0 and (probe.holds(hi, lo) == (docs >= 10)).all()
    # Counts move up and down, and up again from a filter too full to take more.
    table, false = updated_filter(table, hi, lo, docs, docs[::-1].copy(), 10)
    assert (Probe.of([(0, table, false)], 1).holds(hi, lo) == (docs[::-1] >= 10)).all()
    table, false = updated_filter(table, hi, lo, docs[::-1].copy(), np.full(120, 10), 10)
    assert Probe.of([(0, table, false)], 1).holds(hi, lo).all() and false == b""
    assert not Probe.of([], 4).holds(hi, lo).any()


@pytest.mark.parametrize("most_sent", [line_dedup.MOST_SENT, 0])
def test_batches_in_and_out(spark, tmp_path, most_sent):
    a = [*made(60, 1), (None, None), (None, None), (5, ""), (5, "line 1\n\nLine 2 "), (5, "line 1\n\nLine 2 "), (6, "\n\n")]
    b = made(80, 2, 1000)
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=20, keys_per_shard=8)
    index.insert(frame(spark, a), "a")
    look = lambda rows: answer(index.clean(frame(spark, rows), most_sent=most_sent))
    assert look(a) == plain(a, a, 20)
    before = sorted(map(tuple, index.counts.collect()))
    index.insert(frame(spark, b), "b")
    index.insert(frame(spark, b), "b")
    assert look(a + b) == plain(a + b, a + b, 20) != plain(a, a, 20)
    assert index.filters.count() > 1
    index.delete(frame(spark, b), "b")
    index.delete(frame(spark, b), "b")
    assert look(a) == plain(a, a, 20) and sorted(map(tuple, index.counts.collect())) == before
    with pytest.raises(Exception, match="not in the index"):
        index.delete(frame(spark, b), "c")
    assert look(a) == plain(a, a, 20)
    index.delete(frame(spark, a), "a")
    assert index.counts.isEmpty() and not any(d for _, _, d, _ in look(a))


def test_both_ways_give_the_same(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=3, min_chars=4)
    index.insert(docs, "all")
    want = plain(rows, rows, 3, 4)
    assert answer(index.clean(docs)) == want == answer(index.clean(docs, most_sent=0))
    assert index.clean(docs).columns == [*docs.columns, "n_lines", "n_dropped", "kept"] and sum(d for _, _, d, _ in want) > 50


def test_empty_table_and_a_hot_text(spark):
    assert line_dedup.line_dedup(frame(spark, [])).collect() == []
    rows = [(1, "same\nline\n" + "long " * 20000)] * 15 + [(2, "same"), (3, "a\n" * 30000)]
    out = answer(line_dedup.line_dedup(frame(spark, rows)))
    assert out == plain(rows, rows, 10)
