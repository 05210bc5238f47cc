"""Text expressions. All are built-in column expressions, so they stay inside whole-stage code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftload.functions.numbers import PLAIN_NUMBER_PATTERN, number_from_text

# The characters taken out of free text, and the numbered customer id patterns.
LINE_BREAKS = "\n\r"
CONTROL_AND_SEPARATORS = "\n\f\r;^"
SHORT_SUFFIX_ID = "R%R___"
LONG_SUFFIX_ID = "R%R%"
CURRENCY = "zł"
DOMAIN_PREFIX_LENGTH = 3


def str_replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def strip_control_chars(c: Column, chars: str = CONTROL_AND_SEPARATORS) -> Column:
    return F.translate(c, chars, "")


def substring_fixed(c: Column, start: int, length: int) -> Column:
    """Positions below 1 count towards the length: ``(0, 11)`` gives the first 10 characters."""
    if start < 1:
        length, start = length + start - 1, 1
    return F.substring(c, start, max(length, 0))


def strip_domain_prefix(c: Column, length: int = 100, *, lower: bool = False) -> Column:
    """Login without its 3-character domain."""
    login = F.substring(c, DOMAIN_PREFIX_LENGTH + 1, length)
    return F.lower(login) if lower else login


def login_without_domain(c: Column) -> Column:
    """Login after its backslash, in lower case; a login without one is kept."""
    return F.lower(F.substring_index(c, "\\", -1))


def normalise_customer_id(c: Column, *first_choices: Column) -> Column:
    """``R<id>R<3 characters>`` is kept, any other ``R<id>R...`` becomes ``<id>``, the rest is kept.

    A first choice that is not null wins unchanged.
    """
    upper = F.upper(c)
    between = F.substring(c, F.lit(2), F.locate("R", upper, 2) - F.lit(2))
    plain = F.when(upper.like(SHORT_SUFFIX_ID), c).when(upper.like(LONG_SUFFIX_ID), between).otherwise(c)
    return F.coalesce(*first_choices, plain) if first_choices else plain


def prefix_before_dash(c: Column) -> Column:
    """Text before the first dash without the blank in front of it; ``''`` when there is no dash."""
    return F.when(c.contains("-"), F.substring(c, F.lit(1), F.locate("-", c) - F.lit(2))).otherwise(F.lit(""))


def suffix_after_underscore(c: Column) -> Column:
    """Part after the last underscore, ``''`` when there is none. Trailing blanks do not count."""
    return F.regexp_extract(F.rtrim(c), "_([^_]*)$", 1)


def trim_both(c: Column) -> Column:
    return F.trim(c)


def find_position(c: Column, sub: str, start: int = 1) -> Column:
    return F.locate(sub, c, start)


def contains_letters(c: Column) -> Column:
    return c.rlike("[A-Za-z]")


def clean_number_text(c: Column) -> Column:
    """Text form of an amount: no outer or inner blanks, decimal point for comma."""
    return F.translate(F.trim(c), ", ", ".")


def clean_money_text(c: Column) -> Column:
    """Amount as a number. Text that still holds a letter, or is no number, gives 0."""
    bare = F.translate(F.replace(clean_number_text(c), F.lit(CURRENCY), F.lit("")), "'", "")
    return F.coalesce(number_from_text(bare, PLAIN_NUMBER_PATTERN), F.lit(0.0))


def split_code(c: Column, parts: int = 4, separator: str = r"\|") -> list[Column]:
    """The first ``parts`` parts of a delimited code; null where the code is shorter."""
    pieces = F.split(c, separator)
    return [F.get(pieces, i) for i in range(parts)]


def truncate_text(c: Column, length: int = 450) -> Column:
    """First ``length`` characters after writing ``&`` out and dropping single quotes."""
    return F.substring(F.translate(F.replace(c, F.lit("&"), F.lit(" AND ")), "'", ""), 1, length)


def remap_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """Whole values renamed, others kept."""
    out = None
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)) if out is None else out.when(c == old, F.lit(new))
    return c if out is None else out.otherwise(c)


def replace_whole_value(c: Column, old: str, new: str) -> Column:
    return remap_values(c, {old: new})


def like_label(c: Column, patterns: Mapping[str, str], default: str | None = "") -> Column:
    """Label of the first ``LIKE`` pattern that fits."""
    out = None
    for pattern, label in patterns.items():
        out = F.when(c.like(pattern), F.lit(label)) if out is None else out.when(c.like(pattern), F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def guid_to_text(c: Column) -> Column:
    return F.translate(c.cast("string"), " ", "")


def concat_text(*parts: Column | str) -> Column:
    """Null when any part is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def concat_name(first: Column, last: Column) -> Column:
    return concat_text(first, " ", last)


def blank_if_null(c: Column, blank: str = "") -> Column:
    return F.coalesce(c, F.lit(blank))


def sentinel_to_null(c: Column, sentinel: str = "null") -> Column:
    return F.nullif(c, F.lit(sentinel))


def folded(c: Column) -> Column:
    """The form in which the source compares text: case and trailing blanks do not count."""
    return F.lower(F.rtrim(c))


def fold(value: str) -> str:
    return value.rstrip(" ").lower()


def equals_ignore_case(a: Column, b: Column) -> Column:
    return folded(a) == folded(b)


def is_text(c: Column, value: str) -> Column:
    return folded(c) == fold(value)


def is_one_of(c: Column, values: Iterable[str]) -> Column:
    return folded(c).isin(*[fold(v) for v in values])


def fits(c: Column, pattern: str) -> Column:
    """``LIKE`` as the source compares; blanks at the end of the pattern count, as there."""
    return F.lower(c).like(pattern.lower())
