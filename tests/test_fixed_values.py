"""The fixed lists by hand, so that a slip in them shows: the checks take some of them from the code."""

import re

import pytest

from siftload.functions import text
from siftload.plans import fixed_values as fv


def test_progress_products():
    assert fv.PROGRESS_PRODUCTS == [
        "id.a.36", "id.a.438", "id.a.439", "id.a.440", "id.a.441", "id.a.479", "sd.a.53", "sd.a.68",
        "sd.a.78", "sd.a.79", "sd.a.7", "sd.a.80", "sd.a.81", "sd.a.86", "sd.a.87", "sd.a.88",
    ]
    assert fv.UPKEEP_PRODUCT not in fv.PROGRESS_PRODUCTS


def test_service_patterns():
    assert sorted(fv.SERVICE_PATTERNS) == sorted(
        ["fix_service_(%", "fix_service_ons%", "fix_service_fixvoice%", "fix_service_ssl%"]
        + [f"fix_option_{name}%" for name in ("miejski", "other", "itdf", "managed", "pabx", "printer", "map_of_competences")]
    )
    assert fv.SERVICE_RENAMES == {"fix_service_ons_1": "fix_service_ons_355", "fix_service_ons_2": "fix_service_ons_356"}


def test_families_are_target_columns_with_name_patterns():
    from siftload.plans import pils_fix

    assert set(fv.SERVICE_FAMILIES) <= set(pils_fix.TARGET)
    assert all(re.fullmatch(r"[a-z0-9_(%)ąćęłńóśźż ]+", p) for patterns in fv.SERVICE_FAMILIES.values() for p in ([patterns] if isinstance(patterns, str) else patterns))


@pytest.mark.parametrize("value, expected", [
    ("x umowa na 12 m", "12"), ("umowa na 24", "24"), ("kontrakt na 24", "24"), ("kontrakt na 12", "12"), ("kontrakt na 12/24", "12"), ("kontrakt na 36", ""),
])
def test_the_first_loyalty_pattern_decides(spark, value, expected):
    from pyspark.sql import functions as F

    row = spark.range(1).select(text.like_label(F.lit(value), fv.LOYALTY_PERIODS).alias("y")).first()
    assert row["y"] == expected
