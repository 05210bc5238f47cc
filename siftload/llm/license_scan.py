"""License scan: ordered signature rules behind a keyword prefilter, overlaps settled by priority and containment."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.llm.common import NOT_WORD, ascii_lower
from siftload.llm.license_rules import Rule, rules

# Fixed values of the base: phrases and their labels. Each of them holds the word the base is gated by.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_GATE = "license"
# Words counted before A-Z are lower-cased.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rule_array(signatures: list[Rule]) -> Column:
    """The rules as one constant; as long as there are rules, whatever the input."""
    rows = [asdict(r) | {"rule": i, "pattern": rf"(?<= ){r.pattern}(?= )"} for i, r in enumerate(signatures)]
    kind = "array<struct<rule:int,label:string,keyword:string,pattern:string,priority:int,weight:double>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def places(text: Column, pattern: Column | str) -> Column:
    """(first, last) word of every match in words that are joined, led and followed by single blanks.

    A match's start follows from the lengths of the pieces between the matches and of the matches before it.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern)
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    both = F.transform(found, lambda m, i: F.struct(blanks(F.get(pieces, i)).alias("gap"), blanks(m).alias("own")))
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    start = F.struct(F.lit(-1).cast("long").alias("at"), none.alias("spans"))

    def add(s: Column, x: Column) -> Column:
        first = s["at"] + x["gap"]
        span = F.struct(first.alias("first"), (first + x["own"]).alias("last"))
        return F.struct((first + x["own"]).alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(both, start, add, lambda s: s["spans"])).otherwise(none)


def detections(joined: Column, signatures: list[Rule]) -> Column:
    """Every detection in a normalised text: rule, label, priority, weight, first and last word."""
    gated = F.filter(rule_array(signatures), lambda r: F.contains(joined, r["keyword"]))

    def of(r: Column) -> Column:
        return F.transform(
            places(joined, r["pattern"]),
            lambda p: F.struct(
                p["first"].alias("first"), p["last"].alias("last"), r["rule"].alias("rule"), r["label"].alias("label"),
                r["priority"].alias("priority"), r["weight"].alias("weight"),
            ),
        )

    return F.flatten(F.transform(gated, of))


def surviving(found: Column) -> Column:
    """Drops a detection that lies inside another of higher priority (ties: the longer one, then the earlier rule)."""

    def suppressed_by(a: Column, b: Column) -> Column:
        inside = (b["first"] <= a["first"]) & (a["last"] <= b["last"])
        gain = (b["last"] - b["first"]) - (a["last"] - a["first"])
        stronger = b["priority"] > a["priority"]
        tie = b["priority"] == a["priority"]
        return inside & (stronger | (tie & ((gain > 0) | ((gain == 0) & (b["rule"] < a["rule"])))))

    return F.filter(found, lambda a: ~F.exists(found, lambda b: suppressed_by(a, b)))


def gate_words(signatures: list[Rule]) -> list[str]:
    """The longest word of each keyword: a text with none of them meets no rule."""
    return sorted({max(r.keyword.split(), key=len) for r in signatures} | {BASE_GATE})


def scan_licenses(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """Licenses each document refers to: one row per document row.

    Returns doc_id, n_words, the base figures (n_base places of the base phrases, first_word, last_word, base_labels),
    labels (base ones and those of the surviving detections, sorted, comma-joined), score (0 to 1: certainty that the
    text is under a license, from the surviving detections' weights) and found (the surviving detections).
    Null and empty texts have no words, no labels, score 0. Repeated rows come back repeated. Extra columns are not read.

    Texts are split into words only when they hold a gate word; a rule's regex runs only when its keyword stands in
    the words. All of it happens inside the row, so nothing is shuffled.
    """
    signatures = rules() if signatures is None else signatures
    text = F.coalesce("text", F.lit(""))
    low = F.lower(text)
    gate = F.lit(False)
    for word in gate_words(signatures):
        gate = gate | F.contains(low, F.lit(word))
    words = F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")
    joined = F.when(gate, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    no_base = F.array().cast("array<struct<first:bigint,label:string>>")
    no_found = F.array().cast("array<struct<first:bigint,last:bigint,rule:int,label:string,priority:int,weight:double>>")

    def base_places(phrase: str, label: str) -> Column:
        found = places(F.col("joined"), f"(?<= ){phrase}(?= )")
        return F.transform(found, lambda p: F.struct(p["first"].alias("first"), F.lit(label).alias("label")))

    base = F.concat(*[base_places(phrase, label) for phrase, label in BASE_PHRASES.items()])
    gated = F.col("joined").isNotNull()
    scanned = (
        docs.select("doc_id", F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"), joined.alias("joined"))
        .select(
            "doc_id", "n_words",
            F.when(F.contains("joined", F.lit(BASE_GATE)), base).otherwise(no_base).alias("base"),
            F.when(gated, detections(F.col("joined"), signatures)).otherwise(no_found).alias("all"),
        )
        .select("doc_id", "n_words", "base", surviving(F.col("all")).alias("found"))
    )
    names = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda x: x["label"])))
    doubt = F.aggregate("found", F.lit(1.0), lambda d, x: d * (1 - x["weight"] * 0.98))
    return scanned.select(
        "doc_id", "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["first"])).alias("last_word"),
        F.array_join(names(F.col("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(names(F.col("base")), names(F.col("found"))))), ",").alias("labels"),
        F.round(1 - doubt, 6).alias("score"),
        F.transform("found", lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first"), x["last"].alias("last"))).alias("found"),
    )
