"""Joins against code dictionaries, users and other small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.functions.text import folded


def dictionary_slice(
    dictionary: DataFrame, attribute: str, entity: int | None = None, lang: int | None = None
) -> DataFrame:
    """Codes and labels of one attribute. Attribute names compare without case.

    Leaving out the entity keeps the codes of every entity that has the attribute.
    """
    hit = F.lower(F.col("attributename")) == attribute.lower()
    if entity is not None:
        hit = hit & (F.col("objecttypecode") == entity)
    if lang is not None:
        hit = hit & (F.col("langid") == lang)
    return dictionary.where(hit)


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    code: str | Column,
    out: str,
    *,
    attribute: str,
    entity: int | None = None,
    lang: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Adds the label of a code. An inner decode drops rows whose code has no label.

    A code listed twice multiplies rows, as a join does; without an entity that is to be expected.
    """
    labels = dictionary_slice(dictionary, attribute, entity, lang).select(
        F.col("attributevalue").alias("__code"), F.col("value").alias(out)
    )
    code = F.col(code) if isinstance(code, str) else code
    return df.join(labels, code == F.col("__code"), how).drop("__code")


def has_code(
    df: DataFrame,
    dictionary: DataFrame,
    code: str | Column,
    *,
    attribute: str,
    entity: int | None = None,
    lang: int | None = None,
) -> DataFrame:
    """Rows whose code the dictionary knows; for an inner decode whose label nobody reads."""
    codes = dictionary_slice(dictionary, attribute, entity, lang).select(F.col("attributevalue").alias("__code"))
    code = F.col(code) if isinstance(code, str) else code
    return df.join(codes, code == F.col("__code"), "left_semi")


# Entries of a code map at most; a larger dictionary is joined.
MOST_MAPPED = 2_000

Attribute = tuple[str, int | None, int | None]


class CodeMap:
    """Several attributes of a code dictionary as small maps in the plan, so that all codes of a row become labels in one projection.

    ``attributes`` are (attribute, entity, lang) as in ``dictionary_slice``. One job reads the entries wanted, up to
    ``most``; where there are more, or a code is listed twice (a join would multiply rows), each label is joined as
    ``decode`` does.
    """

    def __init__(self, dictionary: DataFrame, attributes: Sequence[Attribute], most: int = MOST_MAPPED):
        self.dictionary = dictionary
        wanted = list(dict.fromkeys(attributes))
        hits = [F.when(self._hit(*a), F.lit(i)) for i, a in enumerate(wanted)]
        rows = dictionary.select(F.explode(F.array_compact(F.array(*hits))).alias("at"), F.col("attributevalue").cast("int").alias("code"), F.col("value").alias("label"))
        entries = rows.where("code is not null").limit(most + 1).collect()  # no more than that
        self.labels: dict[Attribute, dict[int, str | None]] = {a: {} for a in wanted}
        for r in entries:
            self.labels[wanted[r["at"]]][r["code"]] = r["label"]
        self.mapped = len(entries) <= most and len(entries) == sum(map(len, self.labels.values()))

    @staticmethod
    def _hit(attribute: str, entity: int | None, lang: int | None) -> Column:
        hit = F.lower(F.col("attributename")) == attribute.lower()
        if entity is not None:
            hit = hit & (F.col("objecttypecode") == entity)
        return hit if lang is None else hit & (F.col("langid") == lang)

    def label(self, code: str, attribute: Attribute) -> Column:
        """The label of a code; null for a null or unknown one."""
        pairs = [F.lit(x) for entry in sorted(self.labels[attribute].items()) for x in entry]
        return F.element_at(F.create_map(*pairs), F.col(code).cast("int")) if pairs else F.lit(None).cast("string")

    def decode(self, df: DataFrame, labels: Mapping[str, tuple[str, Attribute]], how: str = "left") -> DataFrame:
        """Adds a label per entry of ``labels``: new column to (code column, attribute). An inner decode drops rows with an unknown code."""
        if not self.mapped:
            for out, (code, (attribute, entity, lang)) in labels.items():
                df = decode(df, self.dictionary, code, out, attribute=attribute, entity=entity, lang=lang, how=how)
            return df
        if how == "inner":
            for code, attribute in labels.values():
                df = df.where(F.col(code).isin(*self.labels[attribute]))
        return df.withColumns({out: self.label(code, attribute) for out, (code, attribute) in labels.items()})


def role(table: DataFrame, prefix: str, key: str, columns: Sequence[str]) -> DataFrame:
    """The key and a few columns of a table, renamed ``<prefix>_<column>`` for one role it plays."""
    return table.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dict.fromkeys([key, *columns])])


def join_role(
    df: DataFrame, table: DataFrame, on: str | Column, prefix: str, key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Joins a table under a role, by ``on`` = its key."""
    on = F.col(on) if isinstance(on, str) else on
    return df.join(role(table, prefix, key, columns), on == F.col(f"{prefix}_{key}"), how)


def compared(df: DataFrame, key: str) -> Column:
    """A key as the source compares it: text without case and trailing blanks, anything else as it is."""
    return folded(F.col(key)) if dict(df.dtypes)[key] == "string" else F.col(key)


def exclude_keys(df: DataFrame, key: str, excluded: DataFrame, excluded_key: str) -> DataFrame:
    """``NOT IN`` a table of keys: a null key is dropped as well."""
    drop = excluded.select(compared(excluded, excluded_key).alias("__drop"))
    return df.where(F.col(key).isNotNull()).join(drop, compared(df, key) == F.col("__drop"), "left_anti")


def keep_keys(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """``IN`` a table of keys."""
    keep = allowed.select(compared(allowed, allowed_key).alias("__keep"))
    return df.join(keep, compared(df, key) == F.col("__keep"), "left_semi")


def flag_keys(df: DataFrame, key: str, listed: DataFrame, listed_key: str, flag: str) -> DataFrame:
    """Adds a true/false column: is the key listed? Keeps every row once."""
    marks = listed.select(compared(listed, listed_key).alias("__listed")).where("__listed is not null").distinct()
    return (
        df.join(marks, compared(df, key) == F.col("__listed"), "left")
        .withColumn(flag, F.col("__listed").isNotNull())
        .drop("__listed")
    )


def hierarchy_two_up(
    df: DataFrame, people: DataFrame, key: str, parent: str, name: str, *, prefix: str = "up"
) -> DataFrame:
    """Adds the parent's and the grandparent's name of the person whose parent key is in ``parent``."""
    first = people.select(
        F.col(key).alias(f"{prefix}1_key"), F.col(name).alias(f"{prefix}1_name"), F.col(parent).alias(f"{prefix}1_parent")
    )
    second = people.select(F.col(key).alias(f"{prefix}2_key"), F.col(name).alias(f"{prefix}2_name"))
    return df.join(first, F.col(parent) == F.col(f"{prefix}1_key"), "left").join(
        second, F.col(f"{prefix}1_parent") == F.col(f"{prefix}2_key"), "left"
    )


def decode_by_definition(
    df: DataFrame,
    definitions: DataFrame,
    values: DataFrame,
    *,
    definition: str,
    index: str,
    out: str,
    definition_key: str,
    values_definition: str,
    values_index: str,
    values_label: str,
) -> DataFrame:
    """Two-step dictionary: parameter to definition, then the definition's label at an index. Inner."""
    known = definitions.select(F.col(definition_key).alias("__definition"))
    labels = values.select(
        F.col(values_definition).alias("__of"), F.col(values_index).alias("__index"), F.col(values_label).alias(out)
    )
    both = known.join(labels, F.col("__definition") == F.col("__of")).drop("__of")
    return df.join(both, (F.col(definition) == F.col("__definition")) & (F.col(index) == F.col("__index"))).drop(
        "__definition", "__index"
    )
