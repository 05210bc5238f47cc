"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints, as flat node arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.llm.common import text_runs

# Labelled rows a model is fitted on at most: those with the smallest hashes of their ids.
MOST_LABELLED = 20_000
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistics the trees see, and the direction the verdict may take as one grows: less repetition and fewer symbols never hurt.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0,
    "upper_share": 0, "digit_share": 0, "mark_share": 0, "bar_share": -1, "log_line_words": 0, "long_word_share": 0, "top_word_share": -1,
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that stand twice or more in the text, first ones included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    n = len(known)
    pairs = codes[:-1] * n + codes[1:]
    pair_codes = np.unique(pairs, return_inverse=True)[1]
    windows = pair_codes[:-1] * n + codes[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base figures (BASE) and what the trees see (FEATURES). Null and empty texts have zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    if not n:
        return [0, 0, n_symbols, 0, 0], [0.0] * len(FEATURES)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
    seen: set[bytes] = set()
    dup_lines = lines = 0
    for line in raw.split(b"\n"):
        if line.strip(BLANKS):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    ascii_upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    marks = len(raw) - len(raw.translate(None, b"!?.,;:()[]{}\"'"))
    features = [
        float(np.log1p(n)), word_chars / n, n_symbols / word_chars, dup_lines / lines, repeat / n, len(counts) / n,
        ascii_upper / word_chars, digits / word_chars, marks / word_chars, raw.count(b"|") / n, float(np.log1p(n / lines)),
        sum(len(w) > 12 for w in words) / n, max(counts.values()) / n,
    ]
    return [n, word_chars, n_symbols, dup_lines, repeat], features


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


@dataclass
class Trees:
    """All trees as arrays (tree, node); node i has the children 2i+1 (at most the threshold) and 2i+2."""

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.threshold[t, node])
            total += self.value[t, node]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 5.0
) -> Trees:
    """Logistic boosting on histograms. A feature with a direction splits only where the child values keep it, and the
    values below such a split stay on their side of its middle, so the whole model is monotone in that feature."""
    n, width = x.shape
    nodes = 2 ** (depth + 1) - 1
    feature, threshold = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf)
    value = np.zeros((trees, nodes))
    positives = float(y.sum()) if n else 0.0
    start = float(np.log((positives + 1) / (n - positives + 1)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], 1) if n else np.zeros((0, width), np.int64)
    total = np.full(n, start)
    for t in range(trees if 0 < positives < n else 0):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        for i in range(nodes):
            rows = np.flatnonzero(node == i)
            g, w = gradient[rows].sum(), weight[rows].sum()
            value[t, i] = np.clip(g / (w + ridge), low[i], high[i])
            if 2 * i + 2 >= nodes:
                continue
            best = None
            for j in range(width):
                size = len(cuts[j]) + 1
                if size < 2 or len(rows) < 2:
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], gradient[rows], size))[:-1]
                wl = np.cumsum(np.bincount(binned[rows, j], weight[rows], size))[:-1]
                left, right = np.clip(gl / (wl + ridge), low[i], high[i]), np.clip((g - gl) / (w - wl + ridge), low[i], high[i])
                gain = gl**2 / (wl + ridge) + (g - gl) ** 2 / (w - wl + ridge) - g**2 / (w + ridge)
                gain[(wl < 1) | (w - wl < 1) | (directions[j] * (right - left) < 0)] = 0
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                    best = (gain[k], j, k, left[k], right[k])
            if best is None:
                value[t, [2 * i + 1, 2 * i + 2]] = value[t, i]
                low[[2 * i + 1, 2 * i + 2]] = high[[2 * i + 1, 2 * i + 2]] = value[t, i]
                node[rows] = 2 * i + 1
                continue
            _, j, k, left, right = best
            feature[t, i], threshold[t, i] = j, cuts[j][k]
            for child in (2 * i + 1, 2 * i + 2):
                low[child], high[child] = low[i], high[i]
            middle = (left + right) / 2
            if directions[j] > 0:
                high[2 * i + 1], low[2 * i + 2] = middle, middle
            elif directions[j] < 0:
                low[2 * i + 1], high[2 * i + 2] = middle, middle
            node[rows] = 2 * i + 1 + (binned[rows, j] > k)
        value[t] *= rate
        total += value[t, node]
    return Trees(depth, feature, threshold, value, start)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """text and y of the ``most`` labelled texts with the smallest hashes; equal texts count once, as good if any of them is.

    The bound is on texts, so it also holds where a labelled id stands in very many rows, and neither the label nor the
    features have a say in it. Texts are read only once they are chosen. A null text counts as an empty one.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select("doc_id", F.xxhash64(text).alias("hash"))
    chosen = hashed.join(known, "doc_id").groupBy("hash").agg(F.max("y").alias("y")).orderBy("hash").limit(most)
    rows = docs.select(text.alias("text"), F.xxhash64(text).alias("hash")).join(F.broadcast(chosen), "hash")
    return rows.groupBy("text").agg(F.max("y").alias("y"))


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Trees:
    """Trees for ``labels.quality``, from at most ``most`` labelled texts."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(statistics(t)[1]).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())], ["y", "x"])

    rows = labelled_sample(docs, labels, "quality", most).mapInArrow(features, "y int, x binary").collect()  # no more than that
    rows.sort(key=lambda r: (bytes(r["x"]), r["y"]))
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r["y"] for r in rows], float), list(FEATURES.values()))


def rate_quality(docs: DataFrame, trees: Trees, least: float = 0.5) -> DataFrame:
    """doc_id, the base figures, base_failed, quality (the trees' probability) and kept, one row per document row.

    kept is false when the base fails, else whether quality reaches ``least``. Null and empty texts have zeros and
    fail the base. Rows are handled one by one, so ties and repeated rows don't matter; extra columns are not read.
    """
    integers = ", ".join(f"{c} long" for c in BASE)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, "text"):
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            base = np.array([b for b, _ in found], np.int64).reshape(len(found), len(BASE))
            quality = trees.probability(np.array([x for _, x in found]).reshape(len(found), len(FEATURES)))
            failed = base_failed(base[:, 0], base[:, 4])
            columns = [batch.column(0), *[pa.array(base[:, i]) for i in range(len(BASE))]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(failed), pa.array(quality), pa.array(~failed & (quality >= least))],
                ["doc_id", *BASE, "base_failed", "quality", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {kind}, {integers}, base_failed boolean, quality double, kept boolean")
