"""Ordered rules as data: facts are bits of one number, rules are masks, and the first that fits gives the label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_FACTS = 31


@dataclass(frozen=True)
class RuleTable:
    """Rules over named facts. A rule is a label and the facts it needs, each to hold or not to hold.

    A fact is a condition; one that is null neither holds nor doesn't, so no rule that asks for it fits, as in a chain
    of conditions. Each fact takes two bits, for holding and for not holding, and a rule is the mask of the bits it needs.
    """

    facts: tuple[str, ...]
    rules: list[tuple[str, dict[str, bool]]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if len(self.facts) > MOST_FACTS:
            raise ValueError(f"{len(self.facts)} facts don't fit in one number")
        unknown = {f for _, needs in self.rules for f in needs} - set(self.facts)
        if unknown:
            raise ValueError(f"rules ask for facts that aren't there: {sorted(unknown)}")

    def mask(self, needs: Mapping[str, bool]) -> int:
        return sum(1 << (2 * self.facts.index(f) + (not holds)) for f, holds in needs.items())

    def rows(self) -> list[tuple[int, int, str]]:
        """(position, mask, label): the table as it may be stored and read again."""
        return [(i, self.mask(needs), label) for i, (label, needs) in enumerate(self.rules)]

    @staticmethod
    def of_rows(facts: Sequence[str], rows: Sequence[tuple[int, int, str]]) -> RuleTable:
        """The inverse of ``rows``; positions give the order."""
        needs = lambda mask: {f: hold for i, f in enumerate(facts) for hold in (True, False) if mask >> (2 * i + (not hold)) & 1}
        return RuleTable(tuple(facts), [(label, needs(mask)) for _, mask, label in sorted(rows)])

    def bits(self, conditions: Mapping[str, Column]) -> Column:
        """The facts of a row as one number."""
        each = [F.when(conditions[f], F.lit(1 << 2 * i)).when(~conditions[f], F.lit(2 << 2 * i)).otherwise(F.lit(0)).cast("long") for i, f in enumerate(self.facts)]
        return reduce(lambda a, b: a.bitwiseOR(b), each)

    def first_fit(self, bits: Column, default: str | None = "") -> Column:
        """The label of the first rule whose bits are all set in ``bits``."""
        out = None
        for _, mask, label in self.rows():
            fits = bits.bitwiseAND(F.lit(mask).cast("long")) == F.lit(mask).cast("long")
            out = F.when(fits, F.lit(label)) if out is None else out.when(fits, F.lit(label))
        return F.lit(default) if out is None else out.otherwise(F.lit(default))

    def classify(self, df: DataFrame, conditions: Mapping[str, Column], out: str, default: str | None = "") -> DataFrame:
        """Adds the label of each row. The number is worked out once and stands in a column of its own meanwhile."""
        marked = df.withColumn("__facts", self.bits(conditions))
        return marked.withColumn(out, self.first_fit(F.col("__facts"), default)).drop("__facts")

    def never_fit(self, excluded: Sequence[Mapping[str, bool]] = ()) -> dict[int, str]:
        """Positions of rules that can never give a label, and why.

        A rule never fits where it asks for what can't be: a fact that holds and doesn't, or one of the ``excluded``
        combinations. It never comes to its turn where an earlier rule asks for no more than it does.
        """
        out: dict[int, str] = {}
        impossible = [self.mask(x) for x in excluded]
        masks = [m for _, m, _ in self.rows()]
        for i, mask in enumerate(masks):
            if any(mask & x == x for x in impossible):
                out[i] = "asks for what can't be"
            else:
                earlier = next((j for j in range(i) if mask & masks[j] == masks[j] and j not in out), None)
                if earlier is not None:
                    out[i] = f"rule {earlier} comes first"
        return out


def any_of(label: str, base: Mapping[str, bool], *alternatives: Mapping[str, bool]) -> list[tuple[str, dict[str, bool]]]:
    """One rule per alternative, each with the base; ones that contradict the base are left out."""
    joined = [{**base, **a} for a in alternatives if all(base.get(k, v) == v for k, v in a.items())]
    return [(label, needs) for needs in joined]
