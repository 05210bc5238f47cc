"""Indexed upserts, counted derived tables, and runs that are taken up again."""

import pytest
from pyspark.sql import functions as F

from siftload.plans import DONE, FAILED, NOT_STARTED, SKIPPED, Plan, run_all
from siftload.plans.params import Params
from siftload.session import work_dir
from siftload.sinks import merge
from siftload.sinks.audit import RunAudit
from siftload.sinks.derived import DerivedTarget
from siftload.sinks.target import ParquetTarget
from siftload.sources.tables import Tables

c = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_scanned(df):
    """Rows that the file scans of an executed frame gave out; row groups that were skipped give none."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def indexed(spark):
    target = ParquetTarget(spark, work_dir(spark) + "/t", partition_by=["part"], key_index="id", row_group_bytes=64 << 10)
    content = spark.range(200_000).select((c("id") * 2).alias("id"), F.xxhash64("id").cast("string").alias("v"), (c("id") % 4).cast("int").alias("part"))
    target.full_refresh(content)
    return target


def test_few_keys_read_few_row_groups(spark, indexed):
    near = spark.range(100).select((c("id") * 2 + 100_000).alias("id"))
    assert indexed.rows_with_keys(near, ["id"]).count() == 100
    assert rows_scanned(indexed.rows_with_keys(near, ["id"])) < 40_000
    # Keys between the stored ones lie within the bounds of row groups: Bloom filters skip them.
    absent = spark.range(100).select((c("id") * 4000 + 1).alias("id"))
    assert rows_scanned(indexed.rows_with_keys(absent, ["id"])) < 100_000
    assert indexed.rows_with_keys(spark.range(0).select("id"), ["id"]).count() == 0
    many = spark.range(3000).select((c("id") * 2).alias("id"))
    assert indexed.rows_with_keys(many, ["id"]).count() == 3000


def test_indexed_upsert_touches_its_partitions_only(spark, indexed):
    before = {p: set(spark.read.parquet(f"{indexed.folder()}/part={p}").inputFiles()) for p in range(4)}
    source = spark.createDataFrame([(0, "new", 9), (8, "new", 9), (None, "keyless", 7), (-3, "added", 7)], "id long, v string, part int")
    indexed.merge(source, ["id"], update=["v"], insert_only=["part"])
    got = indexed.read().where("v in ('new', 'keyless', 'added')")
    assert rows(got.select("id", "v", "part")) == [(-3, "added", 7), (0, "new", 0), (8, "new", 0), (None, "keyless", 7)]
    after = {p: set(spark.read.parquet(f"{indexed.folder()}/part={p}").inputFiles()) for p in range(4)}
    assert before[0] != after[0] and all(before[p] == after[p] for p in (1, 2, 3)) and indexed.read().count() == 200_002


def test_upserts_of_wide_rows_are_not_broadcast(spark, frame, monkeypatch):
    import siftload.sources.tables as tables

    target = frame([(1, "a"), (None, "b")], "id int, v string")
    source = frame([(1, "x" * 5000), (2, "y")], "id int, v string")
    plans = []
    for limit in (tables.MAX_BROADCAST_BYTES, 1000):
        monkeypatch.setattr(tables, "MAX_BROADCAST_BYTES", limit)
        out = merge.merge_upsert(target, source, ["id"], source_rows=2)
        plans.append("strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString())
        assert [len(r[1]) for r in rows(out)] == [5000, 1, 1]
    assert plans == [True, False]


def test_keyed_update_takes_null_keys_around_the_join(spark):
    target = spark.range(1000).select(F.when(c("id") % 2 == 0, c("id")).alias("id"), F.lit("old").alias("v"))
    out = merge.keyed_update(target, spark.createDataFrame([(2, "new"), (None, "no")], "id long, v string"), ["id"], ["v"])
    assert out.count() == 1000 and rows(out.where("v <> 'old'")) == [(2, "new")] and out.where("id is null").count() == 500


def test_derived_rows_follow_window_loads(spark, frame):
    schema = "id int, a string, b int"
    loaded, target = (ParquetTarget(spark, f"{work_dir(spark)}/{n}") for n in ("l", "d"))
    derived = DerivedTarget(loaded, target, ["a", "b"])
    loaded.full_refresh(frame([(1, "x", 1), (2, "x", 1), (3, None, None), (4, "y", None), (5, "y", None)], schema))
    derived.replace_window(frame([(9, "z", 9)], schema), c("id") == 9)  # counts anew: nothing was derived before

    def same():
        return rows(derived.counts()) == rows(merge.counted_distinct(loaded.read(), ["a", "b"])) and rows(derived.read()) == rows(loaded.read().select("a", "b").distinct())

    assert same()
    for new, window in (
        ([(2, "x", 1), (6, None, None), (7, "n", 0)], c("id").isin(2, 3)), ([], c("id") >= 4), ([(8, "x", 1)] * 3, F.lit(False)), ([], c("id") < 100), ([(1, "back", 1)], c("b") > 0),
    ):
        assert derived.in_step()
        derived.replace_window(frame(new, schema), window)
        assert same()
    # A load that went past the derived table is seen.
    loaded.full_refresh(frame([(1, "other", 1)], schema))
    assert not derived.in_step()
    derived.replace_window(frame([(2, "x", 1)], schema), c("id") == 2)
    assert same() and derived.read().count() == 2
    with pytest.raises(Exception, match="more rows were removed"):
        merge.derived_change(derived.counts(), frame([("x", 1)] * 2, "a string, b int"), frame([], "a string, b int"), ["a", "b"]).collect()
    with pytest.raises(Exception, match="more rows were removed"):
        merge.derived_change(derived.counts(), frame([("unknown", 1)], "a string, b int"), frame([], "a string, b int"), ["a", "b"]).collect()


class Step(Plan):
    """A plan that gives one row, or fails while its name is in ``broken``."""

    broken: set = set()
    built: list = []
    sources = ()
    needs = ()
    by_owner = ()

    def build(self, tables, params):
        Step.built.append(self.key)
        if self.key in Step.broken:
            raise RuntimeError(f"{self.key} is broken")
        return tables["one"]


def test_a_stopped_run_is_taken_up(spark, frame):
    base = work_dir(spark)
    plans = {p.key: p for p in (Step("a"), Step("b", after=["a"]), Step("c", after=["b"]), Step("d"))}
    targets = {k: ParquetTarget(spark, f"{base}/{k}") for k in plans}
    tables, params = Tables({"one": frame([(1,)], "id int")}), Params(as_of="2025-01-01 00:00:00")
    Step.broken, Step.built = {"b"}, []
    go = lambda run: run_all(plans, tables, params, targets, RunAudit(spark, f"{base}/audit", run))
    assert go("monday") == {"a": DONE, "b": FAILED, "c": NOT_STARTED, "d": DONE} and Step.built == ["a", "b", "d"]
    Step.broken, Step.built = set(), []
    assert go("monday") == {"a": SKIPPED, "b": DONE, "c": DONE, "d": SKIPPED} and Step.built == ["b", "c"]
    assert set(go("monday").values()) == {SKIPPED} and set(go("tuesday").values()) == {DONE}
    seen = RunAudit(spark, f"{base}/audit", "monday")
    assert seen.finished() == set(plans) and seen.read().where("run = 'monday' and error is not null").count() == 1
    assert seen.read().where("message like 'not started%'").select("name").first()[0] == "c"
    assert RunAudit(spark, f"{base}/none", "x").finished() == set() == RunAudit(spark, f"{base}/audit").finished()
