"""Loads by a mark and appends by an id: stops between write and commit, late rows, repeated loads."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.base import Star
from checks.crm import crm_tables
from checks.plan_queries import PARAMS
from siftload.plans import PLANS, run_increment
from siftload.session import work_dir
from siftload.sinks.audit import RunAudit
from siftload.sinks.folder import VersionedFolder
from siftload.sinks.incremental import append_increment, rows_after, rows_since, upsert_increment
from siftload.sinks.target import ParquetTarget

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "id int, v string, at timestamp_ntz"


def day(n, hour=0):
    return datetime(2024, 1, 1, hour) + timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return ParquetTarget(spark, work_dir(spark) + "/t")


class Stopped(Exception):
    pass


def stop(*_, **__):
    raise Stopped


def load(target, df, overlap=timedelta(days=2)):
    return upsert_increment(target, "src.at", df, "at", overlap, ["id"])


def test_mark_moves_with_the_load(frame, target):
    assert target.marks() == {}
    load(target, frame([(1, "a", day(1)), (2, "b", day(10)), (3, "c", None)], SCHEMA))
    assert target.marks() == {"src.at": "2024-01-11 00:00:00"}
    # A late row within the overlap is taken, one before it isn't, and rows without a time always are.
    taken = load(target, frame([(4, "late", day(8)), (5, "too late", day(7)), (2, "b2", day(10)), (6, "new", day(12, 5)), (7, "timeless", None)], SCHEMA))
    assert taken == 4 and [r[:2] for r in rows(target.read())] == [(1, "a"), (2, "b2"), (3, "c"), (4, "late"), (6, "new"), (7, "timeless")]
    assert target.marks() == {"src.at": "2024-01-13 05:00:00"}
    # Nothing new: the mark stays, also where only rows before it are found.
    assert load(target, frame([], SCHEMA)) == 0 and load(target, frame([(6, "new", day(11))], SCHEMA)) == 1
    assert target.marks() == {"src.at": "2024-01-13 05:00:00"}


@pytest.mark.parametrize("partition_by", [[], ["v"]])
def test_a_stop_before_the_commit_reads_the_same_rows_again(spark, frame, monkeypatch, partition_by):
    target = ParquetTarget(spark, work_dir(spark) + "/t", partition_by=partition_by)
    how = {"update": ["at"], "insert_only": ["v"]}
    first, second = [(1, "a", day(1)), (2, "b", day(5))], [(2, "b", day(6)), (3, "a", day(7))]
    upsert_increment(target, "m", frame(first, SCHEMA), "at", timedelta(0), ["id"], **how)
    with monkeypatch.context() as patched:
        patched.setattr(VersionedFolder, "commit", stop)
        with pytest.raises(Stopped):
            upsert_increment(target, "m", frame(first + second, SCHEMA), "at", timedelta(0), ["id"], **how)
    assert target.marks() == {"m": "2024-01-06 00:00:00"}
    # Row 2 again as it stood at the mark, and the two rows of the load that was stopped.
    assert upsert_increment(target, "m", frame(first + second, SCHEMA), "at", timedelta(0), ["id"], **how) == 3
    got = sorted((r["id"], r["v"], r["at"]) for r in target.read().collect())
    assert got == [(1, "a", day(1)), (2, "b", day(6)), (3, "a", day(7))] and target.marks() == {"m": "2024-01-08 00:00:00"}


def test_number_marks_and_other_loads_keep_marks(spark, frame, target):
    df = frame([(1, "a", None), (30, "b", None)], SCHEMA)
    upsert_increment(target, "ids", df, "id", 5, ["id"])
    load(target, df.where("false"))
    target.full_refresh(target.read())
    assert target.marks() == {"ids": "30"}
    assert upsert_increment(target, "ids", spark.range(100).selectExpr("cast(id as int) as id", "'n' as v", "cast(null as timestamp_ntz) as at"), "id", 5, ["id"]) == 75
    assert target.marks() == {"ids": "99"}


def test_cuts_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", day(1))], SCHEMA).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    for df in (rows_since(source, "at", "2024-01-02 00:00:00", timedelta(days=1)), rows_after(source, "at", "2024-01-02 00:00:00")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and ("GreaterThanOrEqual(at,2024-01-01T00:00)" in plan or "GreaterThan(at,2024-01-02T00:00)" in plan)


def test_same_append_twice_is_one_copy(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/t", load_ids=True)
    a, b = frame([(1, "a", None)], SCHEMA), frame([(2, "b", None), (3, "c", None)], SCHEMA)
    for _ in range(2):
        assert target.append(a, load_id="a") and target.append(b, load_id="b / 2")
    assert [r[0] for r in rows(target.read())] == [1, 2, 3] and target.read().columns == ["id", "v", "at"]
    # A repeated load that finds fewer rows, or none, leaves nothing of its first try.
    assert target.append(b.where("id = 2"), load_id="b / 2")
    assert [r[0] for r in rows(target.read())] == [1, 2]
    assert target.append(b.limit(0), load_id="b / 2")
    assert [r[0] for r in rows(target.read())] == [1]
    # Folded into the content by another load, an id is done for good; a full refresh forgets it.
    target.append(b, load_id="b / 2")
    target.merge(frame([(1, "a2", None)], SCHEMA), ["id"])
    assert not target.append(b, load_id="b / 2") and [r[:2] for r in rows(target.read())] == [(1, "a2"), (2, "b"), (3, "c")]
    target.full_refresh(a)
    assert target.append(b, load_id="b / 2") and target.read().count() == 3
    with pytest.raises(ValueError):
        target.append(a)
    with pytest.raises(ValueError):
        ParquetTarget(spark, work_dir(spark) + "/u").append(a, load_id="a")


def test_a_stop_after_the_write_and_before_the_mark(spark, frame, monkeypatch):
    target = ParquetTarget(spark, work_dir(spark) + "/t", load_ids=True)
    append_increment(target, "m", frame([(1, "a", day(1)), (9, "timeless", None)], SCHEMA), "at")
    more = [(1, "a", day(1)), (2, "b", day(2))]
    with monkeypatch.context() as patched:
        patched.setattr(ParquetTarget, "note", stop)
        with pytest.raises(Stopped):
            append_increment(target, "m", frame(more, SCHEMA), "at")
    assert target.marks() == {"m": "2024-01-02 00:00:00"} and target.read().count() == 2
    # The repeat starts from the same mark, finds a row more, and replaces what the first try wrote.
    append_increment(target, "m", frame([*more, (3, "c", day(3))], SCHEMA), "at")
    assert [r[0] for r in rows(target.read())] == [1, 2, 3] and target.marks() == {"m": "2024-01-04 00:00:00"}


def test_a_failed_append_can_be_repeated(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/t", load_ids=True)
    good = frame([(1, "a", None)], SCHEMA)
    with pytest.raises(Exception):
        target.append(good.withColumn("id", F.raise_error("no").cast("int")), load_id="x")
    target.append(good, load_id="x")
    assert target.read().count() == 1


def test_status_history_by_a_mark(spark):
    plan = PLANS["status_history"]
    tables, base = crm_tables(Star(spark, FOLDER), plan.sources), work_dir(spark)
    history = tables["status_history"]
    targets, audit = {"status_history": ParquetTarget(spark, base + "/h")}, RunAudit(spark, base + "/a")
    cut = history.selectExpr("cast(percentile_approx(cast(modifiedon as timestamp), 0.6) as timestamp_ntz)").first()[0]
    first = run_increment(plan, tables.replaced("status_history", history.where(F.col("modifiedon") < F.lit(cut).cast("timestamp_ntz"))), PARAMS, targets, audit)
    second = run_increment(plan, tables, PARAMS, targets, audit)
    whole = plan.build(tables, replace(PARAMS, history_days=None))
    assert 0 < second < first and rows(targets["status_history"].read()) == rows(whole)
    assert [r["rows"] for r in audit.read().orderBy("started_at").collect()] == [first, second]
    with pytest.raises(ValueError):
        run_increment(PLANS["contacts"], tables, PARAMS, targets, audit)
