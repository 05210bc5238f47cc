"""Codes, labels and ordered rule lists as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, str]


def classify(rules: Sequence[Rule], default: str | None = "") -> Column:
    """Label of the first rule that holds; a rule whose condition is null does not hold."""
    if not rules:
        return F.lit(default)
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, label in rules[1:]:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def decode_ladder(c: Column, labels: Mapping[object, str], default: str | None = None) -> Column:
    """Label of a code, ``default`` when the code is unknown or null."""
    return classify([(c == F.lit(code), label) for code, label in labels.items()], default)


def presence_flag(key: Column, yes: str, no: str) -> Column:
    return F.when(key.isNotNull(), F.lit(yes)).otherwise(F.lit(no))


def presence_label(cases: Mapping[tuple[bool, ...], str], flags: Sequence[Column], default: str = "") -> Column:
    """Label picked by which of the flags hold; combinations not listed get the default."""
    rules = []
    for wanted, label in cases.items():
        condition = F.lit(True)
        for flag, want in zip(flags, wanted, strict=True):
            condition = condition & (flag if want else ~flag)
        rules.append((condition, label))
    return classify(rules, default)


def prefer_first(default: object, *choices: Column) -> Column:
    return F.coalesce(*choices, F.lit(default))


def is_in(c: Column, values: Sequence[object]) -> Column:
    return c.isin(*values)
