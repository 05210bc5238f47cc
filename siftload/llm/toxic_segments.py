"""Toxicity by maximum-scoring segments of token log-odds, aggregated by extreme-value calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftload.llm.common import NOT_WORD, ascii_lower, text_runs
from siftload.sources.staging import staged

# Labelled texts the model is learned from at most: those with the smallest hashes.
MOST_LABELLED = 20_000
# Lexicon entries at most, the most significant ones; a parameter, and the model says how many are left out.
MOST_ENTRIES = 50_000
# Rows with this remainder of crc32(doc_id) are held out and never learned from.
FOLDS, HELD_OUT = 4, 2
# A word is looked up whole and by its first characters, so that inflected forms share evidence.
STEMS = (4, 5, 6)
# Weight of the prior: pseudo-documents with the mixture of all labelled documents, as a share of these.
PRIOR_SHARE = 0.15
# What a token's log-odds must reach, in standard deviations and by itself, and the largest score of one token.
LEAST_Z, LEAST_DELTA, MOST_SCORE = 3.0, 2.0, 6.0
# What every other token costs.
DRIFT = 0.05
# A segment is reported when this many or fewer are expected by chance in its document.
MOST_EXPECTED = 0.05

# ASCII to lower case, everything but letters and digits to blanks: the bytes form of the words.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


@dataclass
class Model:
    """Scores of significant tokens (words as ``=word``, stems as they are) and the calibration."""

    scores: dict[str, float]
    decay: float  # lambda of the extreme-value law
    scale: float  # K of the extreme-value law
    intercept: float
    slope: float
    left_out: int = 0  # significant tokens beyond the bound on entries


def held_out() -> F.Column:
    """Whether a row is never learned from; a null id, which has no label either, is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


class TokenScores(dict):
    """Score of a word, worked out once per word and task."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores

    def __missing__(self, word: bytes) -> float:
        text = word.decode("utf-8", "surrogatepass")
        found = [self.scores[k] for k in (f"={text}", *(text[:n] for n in STEMS if len(text) >= n)) if k in self.scores]
        self[word] = score = max(found, default=-DRIFT)
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, total) in linear time (Ruzzo and Tompa).

    Only tokens with positive scores can start or end a segment, so the scan steps from one to the next and takes
    what lies between from the prefix sums.
    """
    hits = np.flatnonzero(scores > 0)
    if not len(hits):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before it, sum after it
    before: list[int] = []  # for each entry the nearest one below it with a smaller sum before it, or -1
    for i in hits.tolist():
        start, end, left, right = i, i + 1, sums[i], sums[i + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = before[j]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right))
                before.append(j)
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:], before[j:]
    return [(s, e, float(r - b)) for s, e, b, r in stack]


def log_odds(df: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """token, delta and z from token, toxic and clean (documents that hold it), under an informative Dirichlet prior:
    pseudo-documents spread like all labelled documents."""
    prior = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE
    prior_docs = (toxic_docs + clean_docs) * PRIOR_SHARE
    odds = lambda seen, n: F.log((F.col(seen) + prior) / (F.lit(n + prior_docs) - F.col(seen) - prior + 1.0))
    delta = odds("toxic", toxic_docs) - odds("clean", clean_docs)
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    return df.select("token", delta.alias("delta"), (delta / spread).alias("z"))


def learning_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text and toxic of the sample; equal texts count once, as toxic if any of them is.

    Of all labelled texts the ``most`` with the smallest hashes are taken. The bound is on texts, not on ids, so it holds
    where ids repeat, and it doesn't see the label. Texts themselves are read only once they are chosen.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    hashed = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("hash"))
    chosen = hashed.join(known, "doc_id").groupBy("hash").agg(F.max("toxic").alias("toxic")).orderBy("hash").limit(most)
    rows = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("hash")).join(F.broadcast(chosen), "hash")
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_entries: int = MOST_ENTRIES) -> Model:
    """Learns from at most ``most`` labelled texts that are not held out; labels and texts are all it reads.

    Token counts are added up by Spark; only significant tokens and one row per sample document come to the driver. Of the
    tokens the ``most_entries`` with the largest z are kept; ``left_out`` of the model counts the others. Without labels
    of both kinds nothing is toxic.
    """
    rows = staged(learning_rows(docs, labels, most))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, clean_docs = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_docs or not clean_docs:
        return Model({}, 1.0, 1.0, -20.0, 0.0)
    words = rows.select("toxic", F.array_distinct(F.array_remove(F.split(ascii_lower(F.col("text")), NOT_WORD), "")).alias("words"))
    whole = F.transform("words", lambda w: F.concat(F.lit("="), w))
    stems = [F.transform(F.filter("words", lambda w: F.length(w) >= n), lambda w: F.substring(w, 1, n)) for n in STEMS]
    # A document counts once for a token, however many of its words begin with it.
    each = words.select("toxic", F.explode(F.array_distinct(F.concat(whole, *stems))).alias("token"))
    counts = each.groupBy("token").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
    significant = log_odds(counts.where("toxic >= 3"), toxic_docs, clean_docs).where((F.col("z") >= LEAST_Z) & (F.col("delta") >= LEAST_DELTA))
    significant = staged(significant)
    kept = significant.orderBy(F.desc("z"), "token").limit(most_entries).collect()
    left_out = significant.count() - len(kept)
    scores = {r["token"]: min(MOST_SCORE, r["delta"]) for r in kept}
    if not scores:
        return Model({}, 1.0, 1.0, -20.0, 0.0, left_out)

    def peak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(scores)
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                values = np.array([known[w] for w in words_of(text)])
                tops = [s for _, _, s in maximal_segments(values)]
                found.append((max(tops, default=0.0), len(values), int((values > 0).sum()), float(values[values > 0].sum())))
            peaks, lengths, hits, mass = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(peaks, pa.float64()), pa.array(lengths, pa.int64()), pa.array(hits, pa.int64()), pa.array(mass, pa.float64())],
                ["toxic", "peak", "n", "hits", "mass"],
            )

    # All rows of the sample, which is bounded; in one order, so that sums of floats are the same in every run.
    seen = sorted(rows.select("text", "toxic").mapInArrow(peak, "toxic int, peak double, n long, hits long, mass double").collect())
    y = np.array([r["toxic"] for r in seen], float)
    peaks, n = np.array([r["peak"] for r in seen]), np.array([max(1, r["n"]) for r in seen], float)
    clean = y == 0
    # Of the clean documents: how often a token scores, and how much.
    hits, mass, tokens_read = (float(sum(r[c] for r in seen if r["toxic"] == 0)) for c in ("hits", "mass", "n"))
    decay = decay_rate((hits + 0.5) / (tokens_read + 1), mass / hits if hits else MOST_SCORE / 2)
    # K from how many clean documents reach a middling chance peak: K * exp(-decay * peak) * words is what is expected.
    chance = peaks[clean & (peaks > 0)]
    middling = float(np.median(chance)) if len(chance) else min(scores.values())
    reached = max(0.5, float((chance >= middling).sum()))
    scale = reached * math.exp(min(600.0, decay * middling)) / float(n[clean].sum())
    x = evidence(peaks, n, decay, scale)
    intercept, slope = logistic(x, y)
    return Model(scores, decay, scale, intercept, slope, left_out)


def decay_rate(share: float, size: float) -> float:
    """The positive root of share * exp(root * size) + (1 - share) * exp(-root * DRIFT) = 1: how fast chance segments
    of clean text die out. When scoring tokens are too common for one, the smallest usable rate."""
    low, high = 1e-6, 50.0
    excess = lambda v: share * math.exp(min(700.0, v * size)) + (1 - share) * math.exp(-v * DRIFT) - 1
    if share * size >= (1 - share) * DRIFT:
        return 0.01
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def evidence(peaks: np.ndarray, n: np.ndarray, decay: float, scale: float) -> np.ndarray:
    """-log10 of the chance of such a peak in clean text of n words: 1 - exp(-K n exp(-lambda S)); 0 to 30."""
    expected = scale * n * np.exp(-decay * peaks)
    chance = -np.expm1(-np.minimum(expected, 700.0))
    return np.where(peaks > 0, np.minimum(30.0, -np.log10(np.maximum(chance, 1e-30))), 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope (never negative) of P(toxic | evidence), by Newton's method with a small ridge."""
    a, b = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([(y - p).sum() - ridge * a, ((y - p) * x).sum() - ridge * b])
        curve = np.array([[w.sum() + ridge, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        a, b = float(a + step[0]), float(b + step[1])
        if np.abs(step).max() < 1e-8:
            break
    return a, max(0.0, b)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Adds toxicity (0 to 1) and toxic_segments (start, end, total; word positions, end excluded) to the rows.

    Every maximal segment that is significant in its document is listed. Null and empty texts have none and get the
    probability of no evidence. Columns of these names are replaced, all others pass. Rows are handled one by one.
    """
    kept = docs.drop("toxicity", "toxic_segments")
    added = StructType.fromDDL("toxicity double, toxic_segments array<struct<start:int,end:int,total:double>>")
    schema = StructType([*kept.schema.fields, *added.fields])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("total", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.scores)
        for batch in text_runs(batches, "text"):
            if len(known) > 1 << 20:
                known.clear()
            peaks, lengths, listed = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                values = np.fromiter(map(known.__getitem__, words), float, len(words))
                segments = maximal_segments(values)
                peaks.append(max((s for _, _, s in segments), default=0.0))
                lengths.append(max(1, len(words)))
                expected = model.scale * len(words) * np.exp(-model.decay * np.array([s for _, _, s in segments]))
                listed.append([{"start": a, "end": b, "total": s} for (a, b, s), e in zip(segments, expected, strict=True) if e <= MOST_EXPECTED])
            x = evidence(np.array(peaks), np.array(lengths, float), model.decay, model.scale)
            toxicity = 1 / (1 + np.exp(-(model.intercept + model.slope * x)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(toxicity), pa.array(listed, kind)], [*batch.schema.names, "toxicity", "toxic_segments"]
            )

    return kept.mapInArrow(score, schema)
