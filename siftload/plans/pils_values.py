"""Settlement values of mobile price calculations as clean numbers with split field codes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.functions import numbers, text
from siftload.operators import sets
from siftload.plans import fixed_values as fv
from siftload.plans.common import c
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("settlement_value", "misc_field")
TARGET = ["sfa_pil_id", "field_code", "field_value", "field_value_czyste", "field_key", "w1", "w2", "w3", "w4"]
FIELDS = ["sfa_pil_id", "field_code", "field_value", "field_key"]


def build(t: Tables, p: Params) -> DataFrame:
    settled = t["settlement_value"].where(c("field_value") != fv.NO_AMOUNT)
    code, value = F.lower("field_code"), F.lower("field_value")
    wanted = (
        code.isin(*[f.lower() for f in fv.SETTLEMENT_FIELDS])
        | code.like(fv.SETTLEMENT_TERMINAL_PATTERN.lower())
        | (code.like(fv.SETTLEMENT_DECLARED_PATTERN.lower()) & (value == fv.SETTLEMENT_RESALE))
    )
    both = sets.union_all(settled.select(*FIELDS), t["misc_field"].where(wanted).select(*FIELDS))
    parts = text.split_code(c("field_code"))
    return both.select(
        numbers.to_number_or_zero(c("sfa_pil_id"), "bigint").alias("sfa_pil_id"),
        "field_code",
        "field_value",
        text.clean_money_text(c("field_value")).alias("field_value_czyste"),
        "field_key",
        *[part.alias(f"w{i}") for i, part in enumerate(parts, start=1)],
    )
