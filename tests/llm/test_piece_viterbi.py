"""The piece search against a plain dynamic program, and exact round trips."""

import random
import time

import numpy as np
import public_tokenizers

from siftload.llm import piece_viterbi
from siftload.llm.common import importable

FILE = public_tokenizers.path("piece_bpe_32k.model")
PIECES = piece_viterbi.read_pieces(FILE)
TEXTS = ["", None, "a", "  two  blanks ", "line\nbreak\n\n end", "漢字 🙂 é́ \x00\x01", "x" * 5000, " ", "\n", "The quick brown fox, 1234.", "tab\tand\rmore", "word " * 3000]


def plain_best(text):
    """Best total score of any segmentation."""
    table = {}
    for m in range(1, len(PIECES.hashes)):
        for i, s in zip(PIECES.ids[m].tolist(), PIECES.scores[m].tolist(), strict=True):
            table[PIECES.surface[i].decode()] = s
    text = " " + text
    best = [0.0] + [-np.inf] * len(text)
    for k in range(1, len(text) + 1):
        best[k] = best[k - 1] + PIECES.byte_score * len(text[k - 1].encode())
        for m in range(1, min(16, k) + 1):
            if text[k - m : k] in table:
                best[k] = max(best[k], best[k - m] + table[text[k - m : k]])
    return best[-1]


def score_of(ids):
    scores = {}
    for m in range(1, len(PIECES.hashes)):
        scores.update(zip(PIECES.ids[m].tolist(), PIECES.scores[m].tolist(), strict=True))
    return sum(scores.get(i, PIECES.byte_score) for i in ids)


def test_best_total_and_round_trip():
    rng = random.Random(4)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice("abcdeé ñ\nthing") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    encoder = piece_viterbi.Encoder(PIECES)
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<i4")
        assert piece_viterbi.decode(ids, PIECES) == text
        if len(text) < 400:
            assert abs(score_of(ids.tolist()) - plain_best(text)) < 1e-6


def test_long_words_are_searched_alike(monkeypatch):
    rng = random.Random(9)
    words = ["x" * 300, "é" * 200, "🙂漢" * 90, "a", "ab", *("".join(rng.choices("abcdeéthing🙂", k=rng.randrange(1, 700))) for _ in range(60))]
    for places in (piece_viterbi.PLACES_AT_ONCE, 1, 7, 50):
        monkeypatch.setattr(piece_viterbi, "PLACES_AT_ONCE", places)
        for word in words:
            codes = piece_viterbi.code_points([word])
            assert piece_viterbi.viterbi_long(codes[0], PIECES) == piece_viterbi.viterbi(codes, PIECES)[0]


def test_one_word_of_a_megabyte():
    rng = random.Random(2)
    texts = ["x" * 1_000_000, "".join(rng.choices("abcdefghijklmnoprstu漢字", k=1_000_000))]
    encoder = piece_viterbi.Encoder(PIECES)
    for text in texts:
        began = time.monotonic()
        raw = encoder.encode([text])[0]
        assert time.monotonic() - began < 20
        assert piece_viterbi.decode(np.frombuffer(raw, "<i4"), PIECES) == text
    assert not encoder.kept


def test_kept_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(piece_viterbi, "MOST_KEPT_BYTES", 20_000)
    encoder = piece_viterbi.Encoder(PIECES)
    fresh = piece_viterbi.Encoder(PIECES)
    for i in range(40):
        text = " ".join(f"w{i}x{j}" for j in range(20)) + " same " + "y" * 100
        assert encoder.encode([text]) == [b"".join(fresh.encode([text]))]
        assert encoder.kept_bytes < 40_000 and len(encoder.kept) < 200
    assert len(fresh.kept) < 200


def test_rows(spark):
    importable(spark)
    rows = [(i, t, [1]) for i, t in enumerate(TEXTS)] + [(0, "", [1]), (None, "a", None), (99, "▁", None)]
    got = piece_viterbi.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids array<int>"), FILE).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["round_trip"] == (r["doc_id"] != 99)
        assert r["n_pieces"] == len(r["ids"]) and (r["n_pieces"] == 0) == (not r["text"])


def test_empty(spark):
    importable(spark)
    assert piece_viterbi.encode_documents(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []
