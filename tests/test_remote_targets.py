"""Calls and statements of the targets outside folders. Nothing here reaches a database or a table format."""

import pytest
from pyspark.sql import functions as F

from siftload.plans import PLANS
from siftload.plans.params import Params
from siftload.sinks import remote


class Calls:
    """Records a chain of calls."""

    def __init__(self):
        self.made = []

    def __getattr__(self, name):
        def call(*args):
            self.made.append((name, args))
            return self

        return call


@pytest.fixture
def calls(spark, monkeypatch):
    seen, kind = Calls(), type(spark.range(1))
    monkeypatch.setattr(kind, "writeTo", lambda df, name: seen.writeTo(name))
    monkeypatch.setattr(kind, "mergeInto", lambda df, name, on: seen.mergeInto(name, str(on), sorted(map(tuple, df.collect()), key=str)))
    return seen


def test_table_merge(spark, frame, calls):
    source = frame([(1, "a", "m", 1), (1, "b", "n", 2), (None, "k", "x", 1)], "id int, name string, made string, seq int")
    remote.TableTarget(spark, "cat.db.t").merge(source, ["id"], insert_only=["made"], constants={"active": 1}, order=["seq"])
    names = [name for name, _ in calls.made]
    assert names == ["mergeInto", "whenMatched", "update", "whenNotMatched", "insert", "merge", "writeTo", "append"]
    assert calls.made[0][1][2] == [(1, "b", "m")]
    assert sorted(calls.made[2][1][0]) == ["active", "name"] and sorted(calls.made[4][1][0]) == ["active", "id", "made", "name"]


def test_table_update_window_and_refresh(spark, frame, calls):
    target = remote.TableTarget(spark, "t")
    target.update(frame([(1, "a")], "id int, name string"), ["id"], ["name"])
    target.replace_window(frame([(1,)], "id int"), F.col("id") > 0)
    target.full_refresh(frame([(1,)], "id int"))
    assert [name for name, _ in calls.made] == ["mergeInto", "whenMatched", "update", "merge", "writeTo", "overwrite", "writeTo", "overwrite"]


def test_statements():
    assert remote.merge_statement("t", "s", ["a", "b"], ["c"], ["d"], {"e": "1"}) == (
        "MERGE INTO t t USING s s ON (t.a = s.a AND t.b = s.b) WHEN MATCHED THEN UPDATE SET t.c = s.c, t.e = 1 "
        "WHEN NOT MATCHED THEN INSERT (a, b, c, d, e) VALUES (s.a, s.b, s.c, s.d, 1)"
    )
    assert remote.merge_statement("t", "s", ["a"], ["c"], insert=False) == "MERGE INTO t t USING s s ON (t.a = s.a) WHEN MATCHED THEN UPDATE SET t.c = s.c"
    assert remote.window_statements("t", "s", ["a", "b"], "a > 1") == ["DELETE FROM t WHERE a > 1", "INSERT INTO t (a, b) SELECT a, b FROM s"]
    assert [remote.sql_literal(v) for v in (None, 1, "o'x", 2.5)] == ["NULL", "1", "'o''x'", "2.5"]


def test_plans_load_into_a_database(spark, frame, monkeypatch):
    staged, run = [], []
    monkeypatch.setattr(remote, "jdbc_full_refresh", lambda df, url, table, **o: staged.append((table, sorted(map(tuple, df.collect()), key=str))))
    target = remote.JdbcTarget(spark, "jdbc:x", "contacts", run.extend)
    PLANS["contacts"].load(frame([("1", "a"), ("1", "a")], "ID string, NIP string"), {"contacts": target}, Params(as_of="2025-06-06 00:00:00"))
    assert staged == [("contacts_staging", [("1", "a")])]
    assert run == ["MERGE INTO contacts t USING contacts_staging s ON (t.ID = s.ID) WHEN MATCHED THEN UPDATE SET t.NIP = s.NIP WHEN NOT MATCHED THEN INSERT (ID, NIP) VALUES (s.ID, s.NIP)"]
    with pytest.raises(ValueError):
        target.replace_window(frame([(1,)], "id int"), F.col("id") > 0)
