"""Fees and contract term of fixed-line orders."""

from pyspark.sql import DataFrame

from siftload.functions import dates
from siftload.operators import filters, lookup
from siftload.plans import fixed_values as fv
from siftload.plans.common import blank, c, named
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("fixed_order", "order_parameter", "parameter_definition", "value_definition")
TARGET = ["PKB", "ABO", "INS", "LOJALKA", "DATA"]


def order_values(t: Tables, pattern: str, out: str) -> DataFrame:
    return named(t["order_parameter"], "elob_name", pattern).select(c("elob_sokxorder").alias(f"{out}_of"), c("elob_value").alias(out))


def build(t: Tables, p: Params) -> DataFrame:
    orders = t["fixed_order"].where(
        c("elob_ordernumber").isNotNull() & (c("createdon") >= dates.ntz(p.order_values_from))
    ).select("elob_sokxorder2id", "elob_ordernumber", "createdon")
    term = lookup.decode_by_definition(
        named(t["order_parameter"], "elob_name", fv.CONTRACT_TERM),
        t.lookup("parameter_definition"),
        t.lookup("value_definition"),
        definition="elob_parameterdefinition", index="elob_value", out="term",
        definition_key="elob_parameterdefinitionid",
        values_definition="elob_parameterdefinition", values_index="elob_index", values_label="elob_value",
    ).select(c("elob_sokxorder").alias("term_of"), "term")
    fee = order_values(t, fv.SUBSCRIPTION_FEE_PATTERN, "fee")
    installation = order_values(t, fv.INSTALLATION_FEE_PATTERN, "installation")
    key = c("elob_sokxorder2id")
    joined = orders.join(fee, key == c("fee_of"), "left").join(installation, key == c("installation_of"), "left")
    joined = joined.where(filters.any_not_null(c("fee"), c("installation"))).join(term, key == c("term_of"), "left")
    return joined.select(
        c("elob_ordernumber").alias("PKB"),
        blank(c("fee")).alias("ABO"),
        blank(c("installation")).alias("INS"),
        blank(c("term")).alias("LOJALKA"),
        dates.to_day(c("createdon")).alias("DATA"),
    )
