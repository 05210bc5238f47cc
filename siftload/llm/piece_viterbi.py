"""SentencePiece encoding and decoding by a batched Viterbi search in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftload.llm.common import text_runs

# Fixed values of the format: the blank's stand-in, and the kinds of pieces that are text.
BLANK = "▁"
# Multiplier of the substring hashes (odd, 64 bits).
BASE = np.uint64(0x9E3779B97F4A7C15)
# Words that are searched at once, and bytes of words and ids that a Python worker keeps for later batches.
MOST_AT_ONCE = 1 << 15
MOST_KEPT_BYTES = 128 << 20
# Longer words, which hardly ever have another one of their length beside them, are searched by themselves and not
# kept; their places are probed this many at once.
LONG_WORD = 64
PLACES_AT_ONCE = 1 << 16


@dataclass
class Pieces:
    """A model's pieces as arrays; its size is that of the vocabulary."""

    hashes: list[np.ndarray]  # by length: sorted keys of the pieces of that many characters
    ids: list[np.ndarray]
    scores: list[np.ndarray]
    byte_ids: np.ndarray
    byte_score: float
    unknown: int
    surface: list[bytes]
    lines_apart: bool


def read_pieces(model_file: str) -> Pieces:
    """Reads a SentencePiece model.

    A model of type unigram keeps its log probabilities. The scores of a BPE model are ranks of merges, not
    log probabilities, so ranks become costs by Zipf's law: a piece of rank r costs 1 + ln(r + 1) / ln(pieces), that is,
    fewer pieces come first, then more frequent ones. The best segmentation under these costs is not always the one
    that merging in order of rank ends with.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    raw = np.array([model.get_score(i) for i in range(n)])
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = raw.copy()
    if np.array_equal(raw, np.round(raw)):
        # Whole numbers are ranks. Pieces that no merge makes have a rank beyond all others.
        ranks = np.argsort(np.argsort(-raw[plain], kind="stable"))
        scores[plain] = -1 - np.log(ranks + 1) / np.log(len(plain) + 1)
    longest = max(len(names[i]) for i in plain)
    hashes, ids, by_length = [np.array([], np.uint64)], [np.array([], np.int32)], [np.array([])]
    for length in range(1, longest + 1):
        own = np.array([i for i in plain if len(names[i]) == length], np.int32)
        if len(own):
            codes = np.array([[ord(c) for c in names[i]] for i in own], np.uint64)
            keys = prefix_hashes(codes)[:, -1]
            order = np.argsort(keys)
            own, keys = own[order], keys[order]
            if len(np.unique(keys)) != len(keys):
                raise ValueError("two pieces share a hash; take another BASE")
        else:
            keys = np.array([], np.uint64)
        hashes.append(keys)
        ids.append(own)
        by_length.append(scores[own])
    bytes_at = {names[i]: i for i in range(n) if model.is_byte(i)}
    byte_ids = np.array([bytes_at.get(f"<0x{b:02X}>", model.unk_id()) for b in range(256)], np.int32)
    surface = [b""] * n
    for i in plain:
        surface[i] = names[i].replace(BLANK, " ").encode()
    for b in range(256):
        if byte_ids[b] != model.unk_id():
            surface[byte_ids[b]] = bytes([b])
    lines_apart = not any("\n" in names[i] for i in plain)
    return Pieces(hashes, ids, by_length, byte_ids, float(scores[plain].min()) - 10, model.unk_id(), surface, lines_apart)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the first k characters of each row, k from 0 to the width."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * BASE + (codes[:, k] + np.uint64(1))
    return out


def viterbi(codes: np.ndarray, pieces: Pieces) -> list[bytes]:
    """Best segmentation of words of one length, as little-endian 32-bit ids. All rows advance together.

    At every end position each possible piece length is probed for all words at once; the maxima keep where the last
    piece starts and its id. A character that is no piece costs its UTF-8 bytes. On equal totals the longer last piece wins.
    """
    n, width = codes.shape
    hashed = prefix_hashes(codes)
    powers = np.ones(len(pieces.hashes) + 1, np.uint64)
    powers[1:] = np.cumprod(np.full(len(powers) - 1, BASE, np.uint64))
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0.0
    length_at = np.ones((n, width + 1), np.int16)
    piece_at = np.full((n, width + 1), -1, np.int32)
    utf8 = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    for k in range(1, width + 1):
        best[:, k] = best[:, k - 1] + pieces.byte_score * utf8[:, k - 1]
        for m in range(1, min(k, len(pieces.hashes) - 1) + 1):
            known = pieces.hashes[m]
            if not len(known):
                continue
            sub = hashed[:, k] - hashed[:, k - m] * powers[m]
            at = np.minimum(np.searchsorted(known, sub), len(known) - 1)
            rows = np.flatnonzero(known[at] == sub)
            if not len(rows):
                continue
            at = at[rows]
            total = best[rows, k - m] + pieces.scores[m][at]
            better = total >= best[rows, k]
            rows, at = rows[better], at[better]
            best[rows, k] = total[better]
            length_at[rows, k] = m
            piece_at[rows, k] = pieces.ids[m][at]
    # Back from the end, all words together; the steps come out last piece first.
    position = np.full(n, width)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.arange(n)
    while len(live):
        at = position[live]
        steps.append((live, piece_at[live, at], at))
        position[live] = at - length_at[live, at]
        live = live[position[live] > 0]
    if all((found >= 0).all() for _, found, _ in steps):
        words = np.concatenate([rows for rows, _, _ in reversed(steps)])
        found = np.concatenate([f for _, f, _ in reversed(steps)])
        order = np.argsort(words, kind="stable")
        bounds = np.cumsum(np.bincount(words, minlength=n))
        flat = found[order].astype("<i4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip(np.concatenate([[0], bounds[:-1]]), bounds, strict=True)]
    parts: list[list[bytes]] = [[] for _ in range(n)]
    for rows, found, ends in steps:
        for row, piece, end in zip(rows.tolist(), found.tolist(), ends.tolist(), strict=True):
            if piece >= 0:
                parts[row].append(piece.to_bytes(4, "little"))
            else:
                parts[row].append(pieces.byte_ids[list(chr(int(codes[row, end - 1])).encode())].astype("<i4").tobytes())
    return [b"".join(reversed(p)) for p in parts]


def hits_of(codes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in the codes as (end, length, score, id), by end and length; the hash of every substring grows with its length."""
    found = [(np.array([], np.int64), np.array([], np.int64), np.array([]), np.array([], np.int32))]
    hashed = np.zeros(len(codes), np.uint64)
    for m in range(1, min(len(codes), len(pieces.hashes) - 1) + 1):
        hashed = hashed[: len(codes) - m + 1] * BASE + (codes[m - 1 :] + np.uint64(1))
        known = pieces.hashes[m]
        if len(known):
            at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            starts = np.flatnonzero(known[at] == hashed)
            at = at[starts]
            found.append((starts + m, np.full(len(starts), m), pieces.scores[m][at], pieces.ids[m][at]))
    ends, lengths, scores, ids = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((lengths, ends))
    return ends[order], lengths[order], scores[order], ids[order]


def viterbi_long(codes: np.ndarray, pieces: Pieces) -> bytes:
    """What ``viterbi`` finds for one long word, in time that grows with its length.

    The probes of many places go together instead of those of many words; one pass over the places takes the maxima. Besides
    the way back (six bytes a character) only one slice of places is in memory.
    """
    width, longest = len(codes), len(pieces.hashes) - 1
    length_at = np.ones(width + 1, np.int16)
    piece_at = np.full(width + 1, -1, np.int32)
    costs = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    tail = [0.0]  # best totals of the last places before the slice, its border included
    for low in range(0, width, PLACES_AT_ONCE):
        high = min(width, low + PLACES_AT_ONCE)
        back = len(tail) - 1
        ends, lengths, scores, ids = hits_of(codes[low - back : high], pieces)
        first = np.searchsorted(ends, back, "right")
        bounds = (np.searchsorted(ends, np.arange(back + 1, back + high - low + 2)) - first).tolist()
        lengths, scores, ids = lengths[first:].tolist(), scores[first:].tolist(), ids[first:].tolist()
        best, steps, chosen = tail, [], []
        for place, cost in enumerate((pieces.byte_score * costs[low:high]).tolist()):
            top, step, piece = best[-1] + cost, 1, -1
            for i in range(bounds[place], bounds[place + 1]):
                total = best[-lengths[i]] + scores[i]
                if total >= top:
                    top, step, piece = total, lengths[i], ids[i]
            best.append(top)
            steps.append(step)
            chosen.append(piece)
        length_at[low + 1 : high + 1] = steps
        piece_at[low + 1 : high + 1] = chosen
        tail = best[-longest:]
    out: list[int] = []
    end = width
    while end:
        piece = int(piece_at[end])
        if piece >= 0:
            out.append(piece)
        else:
            out.extend(pieces.byte_ids[list(chr(int(codes[end - 1])).encode())][::-1].tolist())
        end -= int(length_at[end])
    return np.array(out[::-1], "<i4").tobytes()


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4").reshape(len(words), -1).astype(np.uint64)


class Encoder:
    """Ids of words, searched in batches of equal length. Those of short words are kept up to a fixed number of bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0
        lines = "\n" if pieces.lines_apart else ""
        self.words = re.compile(f"{BLANK}*[^{BLANK}{lines}]+|{BLANK}+" + ("|\n" if lines else "")).findall

    def split(self, text: str | None) -> list[str]:
        """Blanks become marks, with one in front. No piece has a mark after another character, so words start at marks."""
        return self.words(BLANK + text.replace(" ", BLANK)) if text else []

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Sees to the ids of the words; returns those of long ones, which are for this batch only."""
        if self.kept_bytes > MOST_KEPT_BYTES:
            self.kept.clear()
            self.kept_bytes = 0
        by_length: dict[int, list[str]] = {}
        for word in words:
            if word not in self.kept:
                by_length.setdefault(len(word), []).append(word)
        long: dict[str, bytes] = {}
        for length, own in by_length.items():
            if length > LONG_WORD:
                long.update((word, viterbi_long(code_points([word])[0], self.pieces)) for word in own)
                continue
            for i in range(0, len(own), MOST_AT_ONCE):
                some = own[i : i + MOST_AT_ONCE]
                found = viterbi(code_points(some), self.pieces)
                self.kept.update(zip(some, found, strict=True))
                # A dictionary entry with its two objects takes about 200 bytes besides what they hold.
                self.kept_bytes += len(some) * (200 + 4 * length) + sum(map(len, found))
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self.split(t) for t in texts]
        long = self.learn(set().union(*split))
        if not long:
            ids = self.kept.__getitem__
            return [b"".join(map(ids, words)) for words in split]
        return [b"".join([long[w] if len(w) > LONG_WORD else self.kept[w] for w in words]) for words in split]


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """Text of ids; the blank that encoding puts in front goes. Bytes that are no UTF-8 show as U+FFFD."""
    surface = pieces.surface
    text = b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return text.removeprefix(" ")


_encoders: dict[int, Encoder] = {}


def encode_documents(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Adds ids (array of int), n_pieces and round_trip (decoding the ids gives the text back) to the rows.

    Null and empty texts have no ids and count as a round trip. A text that itself holds the blank's stand-in
    (U+2581) comes back with blanks in its place, so its round_trip is false. Columns of these names are replaced;
    all others pass. Every row is handled by itself, so ties and repeated rows don't matter. The vocabulary
    goes to the tasks with the function.
    """
    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

    pieces = read_pieces(model_file)
    name = hash((model_file, len(pieces.surface)))
    kept = docs.drop("ids", "n_pieces", "round_trip")
    schema = StructType(
        [*kept.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("n_pieces", LongType()), StructField("round_trip", BooleanType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(name, Encoder(pieces))
        for batch in text_runs(batches, text):
            texts = batch.column(text).to_pylist()
            ids = encoder.encode(texts)
            counts = np.array([len(b) // 4 for b in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<i4")))
            back = [decode(np.frombuffer(b, "<i4"), pieces) == (t or "") for b, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(counts), pa.array(back)], [*batch.schema.names, "ids", "n_pieces", "round_trip"]
            )

    return kept.mapInArrow(encode, schema)
