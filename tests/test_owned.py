"""Attribute tables laid out by owner: the same rows as a plain join, without a shuffle of them."""

import pytest
from pyspark.sql import functions as F

from checks.base import Star
from checks.crm import crm_tables
from checks.plan_queries import PARAMS
from siftload.plans import PLANS, run_all
from siftload.plans.pils_mobile import results
from siftload.plans.projects import mobile_amounts
from siftload.session import work_dir
from siftload.sinks.audit import RunAudit
from siftload.sinks.target import ParquetTarget
from siftload.sources import owned
from siftload.sources.owned import buckets_for, owned_rows, row_bytes
from siftload.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "owner string, name string, value int"


@pytest.fixture
def by_shuffle(spark):
    """Small tables would be broadcast, which says nothing about large ones."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def is_laid_out(df):
    """The rows come from buckets as they are; only ids go through an exchange."""
    plan = plan_of(df)
    return "Bucketed: true" in plan and "Bucketed: false (disabled" not in plan


def test_hot_missing_and_repeated_owners(spark, frame, by_shuffle):
    some = [(f"o{i % 40}", f"n{i}", i) for i in range(400)] + [("hot", "n", i) for i in range(300)] + [(None, "n", 1)] * 3 + [("o1", "n1", 1)] * 2
    table = frame(some, SCHEMA)
    plain = Tables({"x": table})
    wanted = frame([("o1",), ("o1",), ("hot",), (None,), ("nobody",)], "id string")
    with owned_rows(table, "owner", rows_per_bucket=400) as laid_out:
        assert [r[0] for r in laid_out.hot.collect()] == ["hot"] and laid_out.rest.count() == 303
        tables = plain.with_owned({"x": laid_out})
        for ids in (wanted, wanted.limit(0), wanted.where("id = 'hot'"), table.select(F.col("owner").alias("id"))):
            assert rows(tables.rows_of("x", "owner", ids, "id")) == rows(plain.rows_of("x", "owner", ids, "id"))
        assert rows(laid_out.whole()) == rows(table)
        assert is_laid_out(tables.rows_of("x", "owner", wanted, "id"))
        # Another owner column, and a table that was replaced, go the plain way.
        assert rows(tables.rows_of("x", "name", wanted, "id")) == []
        assert rows(tables.replaced("x", table.limit(0)).rows_of("x", "owner", wanted, "id")) == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("owned_")]


def test_empty_and_without_hot_owners(frame, by_shuffle):
    for some in ([], [(f"o{i}", "n", i) for i in range(50)]):
        with owned_rows(frame(some, SCHEMA), "owner") as laid_out:
            assert laid_out.hot is None and laid_out.whole().count() == len(some)
            assert laid_out.of(frame([("o7",), (None,)], "id string"), "id").count() == min(len(some), 1)


def test_number_of_buckets():
    assert buckets_for(0, 10, 8) == 8 and buckets_for(801, 10, 8) == 81 and buckets_for(10**15, 10, 8) == 100_000


def test_few_rows_a_bucket_do_not_make_a_task_each(frame, by_shuffle):
    some = [(f"o{i % 900}", f"n{i}", i) for i in range(5000)] + [("hot", "n", i) for i in range(2000)] + [(None, "n", 1)]
    table = frame(some, SCHEMA)
    wanted = frame([(f"o{i}",) for i in range(0, 900, 7)] + [("hot",), (None,)], "id string")
    with owned_rows(table, "owner", rows_per_bucket=10) as laid_out:
        assert laid_out.buckets == laid_out.bucketed.rdd.getNumPartitions() == 8
        assert [r[0] for r in laid_out.hot.collect()] == ["hot"]
        asked = {r[0] for r in wanted.collect()} - {None}
        found = laid_out.of(wanted, "id")
        assert is_laid_out(found)
        assert rows(found) == rows(table.where(F.col("owner").isin(*asked)))
        assert rows(laid_out.whole()) == rows(table)


def test_wide_rows_have_more_buckets_and_wide_owners_none(monkeypatch, frame, by_shuffle):
    monkeypatch.setattr(owned, "LEAST_BUCKET_BYTES", 10_000)
    table = frame([(f"o{i}", "x" * 936, i) for i in range(300)] + [("wide", "x" * 30_000, 1), (None, None, None)], SCHEMA)
    wanted = frame([("o1",), ("wide",)], "id string")
    with owned_rows(table, "owner", rows_per_bucket=2) as laid_out:
        # 300 rows of about 1,000 bytes and one of 30,000 fill 34 buckets of 10,000; by rows there would be 151.
        assert laid_out.buckets == 34
        assert [r[0] for r in laid_out.hot.collect()] == ["wide"]
        assert sorted(r.owner for r in laid_out.of(wanted, "id").collect()) == ["o1", "wide"]
        assert rows(laid_out.whole()) == rows(table)
    with owned_rows(table, "owner", rows_per_bucket=100) as laid_out:
        assert laid_out.buckets == 8


def test_bytes_of_a_row(frame):
    table = frame([("ab", None, [1, 22], 7), (None, bytearray(b"xyz"), None, None)], "a string, `b.c` binary, l array<int>, n int")
    assert [r[0] for r in table.select(row_bytes(table)).collect()] == [80 + 2 + len("[1, 22]"), 80 + 3]


def test_plans_do_not_shuffle_the_attributes(spark, by_shuffle):
    star = Star(spark, FOLDER)
    tables = crm_tables(star, PLANS["pils_mobile"].sources)
    sold = tables["pl_sales_result"].select(F.col("elob_pandl_id").alias("sold_id"))
    with owned_rows(tables["pl_parameter"], "elob_pl_resultid") as attributes:
        laid_out = tables.with_owned({"pl_parameter": attributes})
        for of in (results, lambda t: mobile_amounts(t, sold)):
            assert is_laid_out(of(laid_out)) and rows(of(laid_out)) == rows(of(tables))


def test_a_run_lays_the_attributes_out_once(spark, monkeypatch):
    import siftload.plans as plans

    made = []

    def noted(shared):
        made.append(sorted(shared))
        return all_owned(shared)

    all_owned = plans.all_owned
    monkeypatch.setattr(plans, "all_owned", noted)
    star, base = Star(spark, FOLDER), work_dir(spark)
    keys = ("pils_fix", "projects")
    tables = crm_tables(star, sorted({name for key in keys for name in PLANS[key].sources}))
    targets = {key: ParquetTarget(spark, f"{base}/{key}") for key in keys}
    audit = RunAudit(spark, f"{base}/audit", "r1")
    assert set(run_all({key: PLANS[key] for key in keys}, tables, PARAMS, targets, audit).values()) == {"done"}
    assert run_all({"projects": PLANS["projects"]}, tables, PARAMS, targets, audit) == {"projects": "skipped"}
    assert made == [["pl_parameter"], []]
    for key in keys:
        plain = PLANS[key].build(tables, PARAMS)
        # The target adds the columns that another plan sets.
        assert rows(targets[key].read().select(*plain.columns)) == rows(plain) != []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("owned_")]
