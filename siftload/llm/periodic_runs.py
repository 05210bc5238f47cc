"""Stretches of words that repeat with a period, found on diagonals of equal lag.

A diagonal of lag q holds the places i with word i equal to word i - q; a maximal stretch of it is a run of period q. A
frequent word has very many earlier occurrences, and opening a diagonal for each would cost the square of the text. Only
primitive periods count, though, and for them one earlier occurrence is enough: inside a run of smallest period q, the
latest earlier occurrence of the k words that end at i (k at least q) stands exactly q words back, since a nearer one would
give the run a smaller period. So the search goes by k = 1, 2, 4 ...: at each, every place is on the one diagonal of its
latest earlier occurrence, places in a row with equal lag q in (k/2, k] extend that diagonal's match length, and where it
ends it is emitted if it is long enough. Places whose k words stand once in the text are on no diagonal for any larger k
and drop out, which is most of them after two or three steps. All texts of a batch go through it together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.llm.common import text_runs

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
ADDED = ("n_words", "runs", "collapsed")


class WordIds(dict):
    """Numbers for words, given in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def equal_neighbours(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices that sort by (key, at), and whether each sorted one has the key of the one before it.

    ``at`` ascends. Key and index are sorted as one number where both fit in 63 bits.
    """
    bits = int(len(at)).bit_length()
    if int(key.max()).bit_length() + bits <= 63:
        packed = np.sort((key << bits) | np.arange(len(at)))
        order, sorted_key = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
    same = np.zeros(len(at), bool)
    same[1:] = sorted_key[1:] == sorted_key[:-1]
    return order, same


def periodic_runs(words: np.ndarray, first: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and period of all runs in texts laid end to end, by start, then period.

    ``words`` are word numbers, ``first`` is for each place the start of its text. A run is a stretch of smallest period q
    and at least max(least, times * q) words that neither neighbour extends. ``times`` is at least 3: from there on a
    stretch long enough for period q on which the latest occurrence is q back has no smaller period.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found by the latest occurrence alone")
    found: list[np.ndarray] = []
    n = len(words)
    longest = int(np.bincount(first).max()) if n else 0
    at, key, k = np.arange(n), first * (int(words.max()) + 1) + words if n else words, 1
    while len(at) and times * (k // 2 + 1) <= longest:
        order, same = equal_neighbours(key, at)
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same[1:], at[order[1:]] - at[order[:-1]], 0)
        # Diagonals at this k: places in a row with one lag in (k/2, k].
        on = np.flatnonzero((lag > k // 2) & (lag <= k))
        if len(on):
            place, period = at[on], lag[on]
            opens = np.ones(len(on), bool)
            opens[1:] = (place[1:] != place[:-1] + 1) | (period[1:] != period[:-1])
            begin = np.flatnonzero(opens)
            end = np.append(begin[1:], len(on)) - 1
            q = period[begin]
            start = place[begin] - k + 1 - q
            length = place[end] + 1 - start
            long_enough = length >= np.maximum(least, times * q)
            found.append(np.stack([start, length, q])[:, long_enough])
        # Places whose k words stand more than once go on, with the k words before theirs.
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(~same)
        repeated = np.zeros(len(at), bool)
        repeated[order] = same | np.append(same[1:], False)
        of_place = np.zeros(n, np.int64)
        of_place[at[repeated]] = number[repeated]
        at = at[repeated]
        at = at[at - 2 * k + 1 >= first[at]]
        at = at[of_place[at - k] > 0]
        key = of_place[at - k] * (len(number) + 1) + of_place[at]
        k *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _batch(batch: pa.RecordBatch, text: str, names: list[str], least: int, times: int) -> pa.RecordBatch:
    # Bytes are split at the ASCII blanks, which are the six that part words.
    texts = [b"" if t is None else t for t in batch.column(text).cast(pa.binary()).to_pylist()]
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = WordIds()
    flat = np.fromiter((i for w in words for i in map(ids.__getitem__, w)), np.int64, int(sizes.sum()))
    start, length, period = periodic_runs(flat, np.repeat(starts, sizes), least, times)
    # Words of a run behind its first period are dropped; runs may lie over each other.
    edges = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges)[:-1] == 0
    text_of = np.searchsorted(starts + sizes, start, side="right")
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
    collapsed = []
    for i, own in enumerate(words):
        if offsets[i] < offsets[i + 1]:
            own = compress(own, kept[starts[i] : starts[i] + sizes[i]].tolist())
        collapsed.append(b" ".join(own).decode())
    values = pa.StructArray.from_arrays([pa.array(start - starts[text_of]), pa.array(length), pa.array(period)], fields=list(RUNS.value_type))
    added = [pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(collapsed, pa.string())]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], [*names, *ADDED])


def find_runs(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """The rows of ``docs`` with n_words, runs (array of start, length, period, by start, then period) and collapsed.

    Words are stretches without the blanks ``[\\x20\\x09-\\x0D]``, numbered from 0. ``collapsed`` is the text's words without
    those a run holds behind its first period, joined by one space. Null and empty texts have no words, no runs (an empty
    array) and an empty ``collapsed``. Every row is worked on alone, so ties and repeated rows don't matter and nothing is
    shuffled; one text is always in one task, with some hundred bytes a word. All other columns pass; columns with the
    names of the new ones are replaced.
    """
    kept = docs.drop(*(c for c in ADDED if c != text))
    schema = kept.select("*", F.lit(0).cast("long").alias("n_words"), F.expr("cast(null as array<struct<start:long,length:long,period:long>>)").alias("runs"), F.lit("").alias("collapsed")).schema
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, text):
            yield _batch(batch, text, names, least, times)

    return kept.mapInArrow(run, schema)


def longest_run(runs: F.Column) -> F.Column:
    """The run of greatest length; of several, the one with the smallest start, then period. Null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))


def with_planted_period(doc_id: F.Column, text: F.Column) -> F.Column:
    """``text``, made periodic from some word on for the documents that the crc32 of their decimal id picks (one in ten).

    With g = floor(crc32 / 10) and n words, every word i from a = g % n on becomes word a + (i - a) % p of the text, where
    p = 1 + floor((n - a) / (3 + g % 8)). A null id picks nothing.
    """
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(crc / 10)

    def made(w: F.Column) -> F.Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p))), " ")

    # The words stand in a struct of their own, so that they are worked out once.
    built = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, made(w)))
    return F.when(crc % 10 == 0, F.coalesce(F.get(built, F.lit(0)), text)).otherwise(text)
