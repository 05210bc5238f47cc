"""Every registered query against DuckDB on the smallest tables."""

import threading

import pytest

import __spark_entry__ as entry
from checks import base
from checks.run import compare, duck
from siftload.plans import fixed_values as fv

FOLDER = "/root/testdata/sf0.001"
# These choose a small part of their tables: at the smallest scale next to nothing is left to compare.
LARGER_FOLDER = "/root/testdata/sf0.01"
LARGER = {"fix_orders", "contacts", "campaigns", "pils_mobile", "e_contracts"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def larger_con():
    return duck(LARGER_FOLDER)


def test_every_query_has_sql():
    assert set(base.QUERIES) == set(base.ORACLE)


def test_entry_lists_the_checked_queries():
    assert set(base.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(base.QUERIES))
def test_query(spark, con, larger_con, key):
    """Equal rows, and some: a comparison of nothing with nothing counts as a problem."""
    folder, engine = (LARGER_FOLDER, larger_con) if key in LARGER else (FOLDER, con)
    problem, rows = compare(engine, entry.oracle_sql()[key], entry.queries()[key](spark, folder))
    assert problem is None and rows > 0


@pytest.mark.parametrize("key", sorted(base.ORACLE))
def test_sql_ends_under_a_row_limit(larger_con, key):
    """Some joins in DuckDB never end when a limit is put right around them."""
    stop = threading.Timer(20, larger_con.interrupt)
    stop.start()
    try:
        assert larger_con.execute(f"SELECT * FROM ({base.ORACLE[key]}) LIMIT 10").fetchall()
    finally:
        stop.cancel()


def test_every_label_of_the_order_rules_occurs(larger_con):
    def values(key, column):
        return {r[0] for r in larger_con.execute(f"SELECT DISTINCT {column} FROM ({base.ORACLE[key]})").fetchall()}

    assert {*fv.UPPER_FLAGS.values(), ""} <= values("fix_orders", "FINALNY_PIL")
    assert len(values("order_progress", "IS_REALIZED_BY_ECONTRACT")) >= 13
    assert len(values("order_progress", "BARRIERS")) >= 9


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
