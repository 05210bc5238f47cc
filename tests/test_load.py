"""Load modes: repeated loads, repeated keys, untouched rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftload.plans import PLANS, run
from siftload.plans.params import Params
from siftload.session import work_area, work_dir
from siftload.sinks import merge
from siftload.sinks.audit import RunAudit
from siftload.sinks.target import ParquetTarget, jdbc_write_options
from siftload.sources.staging import staged
from siftload.sources.tables import Tables, checked_broadcast, jdbc_options

c = F.col
SCHEMA = "id int, name string, made string, active int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return ParquetTarget(spark, work_dir(spark) + "/t", SCHEMA)


def test_full_refresh_twice_keeps_one_copy(frame, target):
    df = frame([(1, "a", "x", 0), (2, "b", "y", 0)], SCHEMA)
    target.full_refresh(df)
    target.full_refresh(df)
    assert rows(target.read()) == rows(df)


def test_failed_refresh_keeps_the_old_content(spark, frame, target):
    target.full_refresh(frame([(1, "a", "x", 0)], SCHEMA))
    broken = frame([(1, "a", "x", 0)], SCHEMA).withColumn("id", F.raise_error("no").cast("int"))
    with pytest.raises(Exception):
        target.full_refresh(broken)
    assert target.read().count() == 1


def test_window_replaces_nothing_outside(frame, target):
    target.full_refresh(frame([(1, "old", None, 0), (5, "old", None, 0), (None, "no id", None, 0)], SCHEMA))
    target.replace_window(frame([(6, "new", None, 0)], SCHEMA), (c("id") >= 5))
    assert [r[:2] for r in rows(target.read())] == [(1, "old"), (6, "new"), (None, "no id")]


@pytest.mark.parametrize("source_rows", [None, 4])
def test_merge(frame, source_rows):
    target = frame([(1, "a", "first", 0), (2, "b", "first", 0)], SCHEMA)
    source = frame(
        [(2, "b2", "later", 1), (2, "b3", "last", 2), (3, "c1", "made", 1), (3, "c2", "unused", 2), (None, "n", "x", 1), (None, "n", "x", 1)],
        "id int, name string, made string, seq int",
    )
    out = merge.merge_upsert(
        target, source, ["id"], update=["name"], insert_only=["made"], constants={"active": 1}, order=["seq"], source_rows=source_rows
    )
    assert rows(out) == [(1, "a", "first", 0), (2, "b3", "first", 1), (3, "c2", "made", 1), (None, "n", "x", 1), (None, "n", "x", 1)]


def test_merge_twice_is_the_same(frame, target):
    source = frame([(2, "b2", "m"), (3, "c", "m")], "id int, name string, made string")
    target.full_refresh(frame([(1, "a", "x", 0), (2, "b", "y", 0)], SCHEMA))
    target.merge(source, ["id"], insert_only=["made"])
    once = rows(target.read())
    target.merge(source, ["id"], insert_only=["made"])
    assert rows(target.read()) == once == [(1, "a", "x", 0), (2, "b2", "y", 0), (3, "c", "m", None)]


def test_merge_of_a_hot_key_is_one_row(spark):
    source = spark.range(50_000).select(F.lit(7).alias("id"), c("id").cast("string").alias("name"), c("id").alias("seq"))
    target = spark.createDataFrame([(7, "old")], "id int, name string")
    assert rows(merge.merge_upsert(target, source, ["id"], update=["name"], order=["seq"])) == [(7, "49999")]


def test_keyed_update(frame, target):
    target.full_refresh(frame([(1, "a", None, 0), (1, "a2", None, 0), (2, "b", None, 0)], SCHEMA))
    target.update(frame([(1, None), (9, "z")], "id int, name string"), ["id"], ["name"])
    assert rows(target.read()) == [(1, None, None, 0), (1, None, None, 0), (2, "b", None, 0)]


def test_partitions_without_new_rows_stay(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/p", partition_by=["made"])
    target.full_refresh(frame([(1, "a", "p1", 0), (2, "b", "p2", 0)], SCHEMA))
    target.replace_partitions(frame([(3, "c", "p2", 0)], SCHEMA))
    assert [r["id"] for r in target.read().orderBy("id").collect()] == [1, 3]


def test_merge_rewrites_touched_partitions_only(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/p", partition_by=["made"])
    target.full_refresh(frame([(1, "a", "p1", 0), (2, "b", "p1", 0), (3, "c", "p2", 0), (4, "d", "p3", 0)], SCHEMA))
    untouched = set(spark.read.parquet(target.folder() + "/made=p2").inputFiles())
    target.merge(frame([(2, "b2", "p3"), (9, "z", "p3"), (8, "y", "p4")], "id int, name string, made string"), ["id"], update=["name"], insert_only=["made"])
    got = sorted(tuple(r) for r in target.read().select("id", "name", "made").collect())
    assert got == [(1, "a", "p1"), (2, "b2", "p1"), (3, "c", "p2"), (4, "d", "p3"), (8, "y", "p4"), (9, "z", "p3")]
    assert set(spark.read.parquet(target.folder() + "/made=p2").inputFiles()) == untouched
    with pytest.raises(ValueError):
        target.merge(frame([(2, "b2", "p3")], "id int, name string, made string"), ["id"])


NULLS = [(1, "a", None, 0), (2, "b", None, 0), (3, "c", "x", 0)]


def files_of(target, spark, partition):
    return set(spark.read.parquet(f"{target.folder()}/made={partition}").inputFiles())


def test_merge_keeps_the_null_partition(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/n", partition_by=["made"])
    target.full_refresh(frame(NULLS, SCHEMA))
    target.merge(frame([(9, "new", None), (2, "b2", "unused")], "id int, name string, made string"), ["id"], update=["name"], insert_only=["made"])
    got = sorted((tuple(r) for r in target.read().select("id", "name", "made").collect()), key=str)
    assert got == [(1, "a", None), (2, "b2", None), (3, "c", "x"), (9, "new", None)]


def test_merge_without_the_partition_column_inserts_into_the_null_partition(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/n", partition_by=["made"])
    target.full_refresh(frame(NULLS, SCHEMA))
    target.merge(frame([(9, "new"), (3, "c2")], "id int, name string"), ["id"], update=["name"])
    got = sorted((tuple(r) for r in target.read().select("id", "name", "made").collect()), key=str)
    assert got == [(1, "a", None), (2, "b", None), (3, "c2", "x"), (9, "new", None)]


def test_window_of_a_partitioned_target(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/w", partition_by=["made"])
    target.full_refresh(frame([*NULLS, (4, "d", "y", 0), (5, "e", "z", 0)], SCHEMA))
    untouched = files_of(target, spark, "x")
    target.replace_window(frame([(6, "new", "z", 0)], SCHEMA), (c("id") == 4) | (c("id") == 2))
    got = sorted((tuple(r) for r in target.read().select("id", "name", "made").collect()), key=str)
    assert got == [(1, "a", None), (3, "c", "x"), (5, "e", "z"), (6, "new", "z")]
    assert files_of(target, spark, "x") == untouched
    target.replace_window(frame([], SCHEMA), c("made").isNull())
    assert sorted(r["id"] for r in target.read().collect()) == [3, 5, 6]


def test_update_of_a_partitioned_target(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/u", partition_by=["made"])
    target.full_refresh(frame([*NULLS, (4, "d", "y", 0)], SCHEMA))
    untouched = files_of(target, spark, "x")
    target.update(frame([(2, "b2"), (4, None), (99, "no")], "id int, name string"), ["id"], ["name"])
    got = sorted((tuple(r) for r in target.read().select("id", "name", "made").collect()), key=str)
    assert got == [(1, "a", None), (2, "b2", None), (3, "c", "x"), (4, None, "y")]
    assert files_of(target, spark, "x") == untouched
    with pytest.raises(ValueError):
        target.update(frame([(1, "p")], "id int, made string"), ["id"], ["made"])


@pytest.mark.parametrize("step", ["create", "delete", "write"])
def test_a_load_that_stops_leaves_old_or_new_content(spark, frame, monkeypatch, step):
    target = ParquetTarget(spark, work_dir(spark) + "/s", SCHEMA)
    target.full_refresh(frame([(1, "a", "x", 0)], SCHEMA))
    target.full_refresh(frame([(1, "a", "x", 0), (2, "b", "y", 0)], SCHEMA))
    real = target.versions._fs()

    class Stopping:
        def __getattr__(self, name):
            if name == step:
                raise OSError("stopped")
            return getattr(real, name)

    if step == "write":
        # A pointer that was begun and never finished.
        monkeypatch.setattr(target.versions, "commit", lambda version, notes: real.create(target.versions._path("_pointers", "0000000009"), False).close())
    else:
        monkeypatch.setattr(target.versions, "_fs", Stopping)
    source = frame([(2, "z", "y", 0)], SCHEMA)
    try:
        target.merge(source, ["id"])
    except OSError:
        pass
    monkeypatch.undo()
    left = rows(target.read())
    assert left == ([(1, "a", "x", 0), (2, "z", "y", 0)] if step == "delete" else [(1, "a", "x", 0), (2, "b", "y", 0)])
    target.merge(source, ["id"])
    assert rows(target.read()) == [(1, "a", "x", 0), (2, "z", "y", 0)]


def test_two_loads_at_once_do_not_both_commit(spark, frame):
    target = ParquetTarget(spark, work_dir(spark) + "/c", SCHEMA)
    target.full_refresh(frame([(1, "a", "x", 0)], SCHEMA))
    number = target.versions._pointers()[-1][0]
    real = target.versions._fs()
    real.create(target.versions._path("_pointers", f"{number + 1:010d}"), False).close()
    assert rows(target.read()) == [(1, "a", "x", 0)]
    with pytest.raises(Exception):
        real.create(target.versions._path("_pointers", f"{number + 1:010d}"), False)


def test_a_folder_of_another_kind_is_refused(spark, frame):
    path = work_dir(spark) + "/f"
    frame([(1, "a", "x", 0)], SCHEMA).write.parquet(path)
    with pytest.raises(FileExistsError):
        ParquetTarget(spark, path, SCHEMA).read()


def test_target_rows_without_a_key_go_around_the_join(spark, frame):
    target = frame([(None, "old", None, 0)] * 3 + [(1, "a", None, 0)], SCHEMA)
    out = merge.merge_upsert(target, frame([(1, "a2"), (2, "b")], "id int, name string"), ["id"], update=["name"])
    assert rows(out) == [(1, "a2", None, 0), (2, "b", None, None), *[(None, "old", None, 0)] * 3]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(id" in plan and "FullOuter" in plan


def test_a_missing_param_stops_before_the_target_is_touched(spark):
    audit = RunAudit(spark, work_dir(spark))
    with pytest.raises(ValueError, match="campaign_creators"):
        run(PLANS["campaigns"], Tables(), Params(as_of="2025-06-06 00:00:00"), {}, audit)
    with pytest.raises(TypeError):
        Params()
    for plan in PLANS.values():
        for name in plan.needs:
            with pytest.raises(ValueError, match=name):
                plan.check(Params(as_of="2025-06-06 00:00:00"))


def test_audit_keeps_the_whole_error(spark, frame):
    audit = RunAudit(spark, work_dir(spark))
    with pytest.raises(ValueError):
        audit.run("bad", lambda: frame([], SCHEMA), lambda df: (_ for _ in ()).throw(ValueError("x" * 5000)))
    assert len(audit.read().first()["error"]) == 5000


def test_work_area_is_removed(spark, frame):
    import os

    with work_area(spark) as folder:
        inside = staged(frame([(1,)], "id int"))
        assert inside.count() == 1 and all(folder in f for f in inside.inputFiles())
    assert not os.path.exists(folder)
    assert not work_dir(spark).startswith(folder)


def test_derived_refresh(spark, frame, target):
    target.append(frame([(1, "a", "x", 0), (2, "a", "x", 0)], SCHEMA))
    derived = ParquetTarget(spark, work_dir(spark) + "/d")
    derived.refresh_from(target, ["name", "made"])
    assert rows(derived.read()) == [("a", "x")]


def test_audit_counts_once_and_records_failure(spark, frame, target):
    audit = RunAudit(spark, work_dir(spark))
    assert audit.run("good", lambda: frame([(1, "a", "x", 0)], SCHEMA), target.append) == 1
    audit.message("good", "note")
    with pytest.raises(ValueError):
        audit.run("bad", lambda: frame([], SCHEMA), lambda df: (_ for _ in ()).throw(ValueError("no right to clear this table")))
    got = {(r["name"], r["rows"], r["message"], r["error"]) for r in audit.read().collect()}
    assert got == {("good", 1, None, None), ("good", None, "note", None), ("bad", None, None, "no right to clear this table")}


def test_plan_runs_with_load_and_audit(spark, frame):
    tables = Tables({
        "opportunity": frame([("o1", "P1", datetime(2021, 1, 1)), ("o2", "P2", datetime(2019, 1, 1)), ("o3", "P3", datetime(2030, 1, 1))], "opportunityid string, elob_opportunityid string, createdon timestamp_ntz"),
        "system_user": frame([(f"u{i}", f"TP\\User{i}", "ICT Sales" if i else "Other") for i in range(7)], "systemuserid string, domainname string, businessunitidname string"),
        "opportunity_user": frame([("o1", f"u{i}") for i in range(7)] + [("o3", "u1"), ("o2", "u0")], "opportunityid string, systemuserid string"),
    })
    projects = ParquetTarget(spark, work_dir(spark) + "/projects")
    none = [None] * 4
    schema = "PROJECT_NUMBER string, USER_ICT_1 string, USER_ICT_2 string, USER_ICT_3 string, USER_ICT_4 string"
    projects.full_refresh(frame([("P1", *none), ("P2", *none), ("P3", "kept", None, None, None)], schema))
    audit = RunAudit(spark, work_dir(spark))
    assert run(PLANS["project_users"], tables, Params(as_of="2025-06-06 00:00:00"), {"projects": projects}, audit) == 1
    assert rows(projects.read()) == [("P1", "user1", "user2", "user3", "user4"), ("P2", *none), ("P3", "kept", None, None, None)]


def test_lookup_beyond_its_bound_is_not_broadcast(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, small = spark.range(50).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
        t = Tables({"big": big, "small": small}, max_broadcast_rows=10)
        facts = spark.range(100).withColumnRenamed("id", "f")

        def plan(lookup):
            return facts.join(lookup, c("f") == c("k"))._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan(t.lookup("small"))
        assert "BroadcastHashJoin" not in plan(t.lookup("big"))
        assert "BroadcastHashJoin" not in plan(checked_broadcast(big, 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jdbc_options():
    read = jdbc_options("jdbc:x", query="select 1", partition_column="id", bounds=(0, 10), num_partitions=4)
    assert read["dbtable"] == "(select 1) src" and read["numPartitions"] == "4" and "query" not in read
    assert jdbc_options("jdbc:x", query="select 1", single_task=True)["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    assert jdbc_write_options("jdbc:x", "t")["batchsize"] == "15000"


def test_unknown_table():
    with pytest.raises(KeyError):
        Tables()["nothing"]
