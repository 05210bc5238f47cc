"""Rule tables against a chain of conditions, with null facts and rules that can't fire."""

import itertools

import pytest
from pyspark.sql import functions as F

from siftload.functions import codes
from siftload.operators.rules import RuleTable, any_of

FACTS = ("a", "b", "x")
RULES = [
    ("first", {"a": True, "b": False}),
    *any_of("either", {"a": True}, {"b": True}, {"x": True}, {"a": False}),
    ("hidden", {"a": True, "b": True, "x": False}),
    ("not a", {"a": False}),
    ("not x", {"x": False}),
    ("none", {}),
]


def test_same_as_the_chain_for_all_values(spark):
    rows = list(itertools.product((True, False, None), repeat=3))
    df = spark.createDataFrame(rows, "a boolean, b boolean, x boolean")
    table = RuleTable(FACTS, RULES)
    again = RuleTable.of_rows(FACTS, table.rows()[::-1])
    assert again.rows() == table.rows()
    chain = []
    for label, needs in RULES:
        condition = F.lit(True)
        for fact, holds in needs.items():
            condition = condition & (F.col(fact) if holds else ~F.col(fact))
        chain.append((condition, label))
    out = again.classify(df, {f: F.col(f) for f in FACTS}, "label").withColumn("want", codes.classify(chain)).collect()
    assert len(out) == 27 and all(r["label"] == r["want"] for r in out)
    assert {r["label"] for r in out} == {"first", "either", "not a", "not x", "none"}
    short = RuleTable(FACTS, RULES[:1])
    assert {r["l"] for r in short.classify(df, {f: F.col(f) for f in FACTS}, "l", None).collect()} == {"first", None}


def test_rules_that_cannot_fire_are_named():
    table = RuleTable(FACTS, RULES)
    # The alternative that contradicts its base was never made a rule.
    assert [label for label, _ in table.rules].count("either") == 2
    assert table.never_fit() == {3: "rule 1 comes first"}
    assert table.never_fit([{"a": False, "b": True}, {"x": False}]) == {3: "asks for what can't be", 5: "asks for what can't be"}
    assert RuleTable(FACTS, [("any", {}), ("late", {"a": True})]).never_fit() == {1: "rule 0 comes first"}


def test_bad_tables_are_refused():
    with pytest.raises(ValueError):
        RuleTable(("a",), [("l", {"b": True})])
    with pytest.raises(ValueError):
        RuleTable(tuple(f"f{i}" for i in range(32)))
