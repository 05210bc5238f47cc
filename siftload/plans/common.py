"""Steps that several plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.functions import dates, text
from siftload.operators import lookup
from siftload.plans import fixed_values as fv
from siftload.plans.params import Params
from siftload.sources.tables import Tables

c = F.col
blank = text.blank_if_null
USER_KEY = "systemuserid"


def label(df: DataFrame, t: Tables, code: str, out: str, at: fv.Code, how: str = "left") -> DataFrame:
    return lookup.decode(
        df, t.lookup("string_map"), code, out, attribute=at.attribute, entity=at.entity, lang=at.lang, how=how
    )


def code_map(t: Tables, *codes: fv.Code) -> lookup.CodeMap:
    return lookup.CodeMap(t.lookup("string_map"), [(x.attribute, x.entity, x.lang) for x in codes])


def labels(df: DataFrame, words: lookup.CodeMap, how: str = "left", **wanted: tuple[str, fv.Code]) -> DataFrame:
    """Adds the label of each code: new column = (code column, its list)."""
    return words.decode(df, {out: (code, (x.attribute, x.entity, x.lang)) for out, (code, x) in wanted.items()}, how)


def known(df: DataFrame, t: Tables, code: str, at: fv.Code) -> DataFrame:
    return lookup.has_code(df, t.lookup("string_map"), code, attribute=at.attribute, entity=at.entity, lang=at.lang)


def user(df: DataFrame, t: Tables, on: str | Column, prefix: str, *columns: str, how: str = "left") -> DataFrame:
    return lookup.join_role(df, t.lookup("system_user"), on, prefix, USER_KEY, columns, how)


def without_test_customers(df: DataFrame, t: Tables, key: str = "elob_sowid") -> DataFrame:
    return lookup.exclude_keys(df, key, t.lookup("excluded_customers"), "elob_sowid")


def named(df: DataFrame, name: str, *patterns: str, like: bool = False) -> DataFrame:
    """Rows whose name fits one of the names; names compare without case. A name with ``%``, or any name when
    ``like`` is set, is a pattern, in which ``_`` stands for any character."""
    lowered = F.lower(c(name))
    hit = F.lit(False)
    for p in patterns:
        hit = hit | (lowered.like(p) if like or "%" in p else lowered == p)
    return df.where(hit)


def calculation_attributes(attributes: DataFrame, name: str, out: str, like: bool = False) -> DataFrame:
    """(calculation result, value) of the attributes with one name."""
    return named(attributes, "elob_name", name, like=like).select(
        c("elob_pl_resultid").alias(f"{out}_of"), c("elob_parametervalue").alias(out)
    )


def local_minutes(column: Column, periods, p: Params) -> Column:
    """Local wall-clock time to the minute, ``''`` for null."""
    shifted = dates.shift_to_zone(column, p.zone) if p.use_zone_rules else dates.shift_hours_by_period(column, periods)
    return blank(dates.date_to_text(shifted, dates.MINUTE_FORMAT))


def owner_in_scope(df: DataFrame, t: Tables, owner: Column) -> DataFrame:
    """Adds the owner's login and keeps rows whose manager's name, one or two levels up, is allowed.

    The scope is worked out on the users, before the activities are touched.
    """
    people = t.lookup("system_user")
    allowed = t.lookup("allowed_managers")
    upper = people.select(c(USER_KEY).alias("upper_key"), c("parentsystemuseridname").alias("upper_boss"))
    scope = people.select(USER_KEY, "domainname", "parentsystemuserid", "parentsystemuseridname").join(
        upper, c("parentsystemuserid") == c("upper_key"), "left"
    )
    scope = lookup.flag_keys(scope, "parentsystemuseridname", allowed, "full_name", "near")
    scope = lookup.flag_keys(scope, "upper_boss", allowed, "full_name", "far")
    scope = scope.where("near or far").select(c(USER_KEY).alias("scope_key"), c("domainname").alias("owner_domainname"))
    return df.withColumn("effective_owner", owner).join(scope, c("effective_owner") == c("scope_key"))
