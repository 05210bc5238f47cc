"""The base figures against a plain version, and the rules by hand."""

import re

from siftload.llm import license_scan
from siftload.llm.license_rules import Rule, rules

SCHEMA = "doc_id long, text string, labels string"
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({name for _, name in at}))


def scan(spark, texts, signatures=None):
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], SCHEMA)
    return license_scan.scan_licenses(df, signatures).orderBy("doc_id").collect()


TEXTS = [
    "Released under the MIT License.", "mit license MIT-license; Apache\nLicense", "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "unlicensed mit-licensed emit license", "", None, "!!", "GNU Lesser General Public License v2.1",
    "nothing here of any kind", "x " * 3000 + "the MIT license " * 200, "public domain, all rights reserved", "Éapache license",
]


def test_base(spark):
    for r, t in zip(scan(spark, TEXTS), TEXTS, strict=True):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_labels(spark):
    labels = [r["labels"] for r in scan(spark, TEXTS)]
    assert labels[0] == "mit"
    assert labels[2] == "gpl,gpl-3.0"
    assert labels[3] == "apache,apache-2.0"
    assert labels[4] == "cc-by-nc-4.0"
    assert labels[9] == "gpl,lgpl-2.1"
    assert labels[10] == "" and labels[12] == "proprietary,public-domain"


def test_suppression_by_priority_and_containment(spark):
    own = [Rule("long", "alpha", "alpha beta gamma", 5, 0.5), Rule("short", "beta", "beta", 1, 0.5), Rule("strong", "gamma", "gamma delta", 9, 0.5), Rule("first", "alpha", "alpha", 5, 0.5)]
    (r,) = scan(spark, ["Alpha beta, gamma delta beta"], own)
    assert [(x["label"], x["first"], x["last"]) for x in sorted(r["found"], key=lambda x: (x["first"], x["last"]))] == [("long", 0, 2), ("strong", 2, 3), ("short", 4, 4)]


def test_hundreds_of_rules_and_their_keywords():
    made = rules()
    assert len(made) > 300
    assert all(re.search(r.keyword.split()[0], r.pattern) for r in made)


def test_empty_and_repeated_rows(spark):
    assert scan(spark, []) == []
    a, b = scan(spark, ["MIT License"] * 2)
    assert a["labels"] == b["labels"] == "mit"


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = license_scan.scan_licenses(docs).collect()
    assert len(got) == len(texts)
    assert all((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(texts[r["doc_id"]]) for r in got)
