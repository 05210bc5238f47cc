"""Joins, rankings and attribute tables on hand-made rows with nulls, ties and hot groups."""

import pytest
from pyspark.sql import functions as F

from siftload.operators import eav, lookup, ranking, sets

c = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def words(frame):
    return frame(
        [(1, "Status", 1033, 1, "one"), (1, "status", 1033, 2, "two"), (2, "STATUS", 1033, 1, "eins"), (1, "status", 1045, 1, "jeden")],
        "objecttypecode int, attributename string, langid int, attributevalue int, value string",
    )


def test_decode_left_inner_and_without_entity(frame, words):
    df = frame([(1,), (2,), (3,), (None,)], "code int")
    left = lookup.decode(df, words, "code", "label", attribute="statUS", entity=1, lang=1033)
    assert rows(left) == [(1, "one"), (2, "two"), (3, None), (None, None)]
    inner = lookup.decode(df, words, "code", "label", attribute="status", entity=1, lang=1033, how="inner")
    assert rows(inner) == [(1, "one"), (2, "two")]
    fanned = lookup.decode(df, words, "code", "label", attribute="status", lang=1033, how="inner")
    assert rows(fanned) == [(1, "eins"), (1, "one"), (2, "two")]
    assert rows(lookup.has_code(df, words, "code", attribute="status", lang=1033)) == [(1,), (2,)]


def test_exclusion_drops_null_keys(frame):
    df, drop = frame([("a",), ("b",), (None,)], "k string"), frame([("a",)], "x string")
    assert rows(lookup.exclude_keys(df, "k", drop, "x")) == [("b",)]
    assert rows(lookup.keep_keys(df, "k", drop, "x")) == [("a",)]
    assert rows(lookup.flag_keys(df, "k", drop.union(drop), "x", "f")) == [("a", True), ("b", False), (None, False)]


def test_ties_for_first_place_all_stay(frame):
    df = frame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "w")], "k string, t int, v string")
    assert rows(ranking.all_first_per_group(df, ["k"], [c("t")])) == [("a", 1, "x"), ("a", 1, "y"), ("b", 5, "w")]
    assert rows(ranking.first_per_group(df, ["k"], [c("t").desc(), c("v")])) == [("a", 2, "z"), ("b", 5, "w")]


def test_split_ranking_equals_plain_ranking_with_a_hot_and_a_null_group(spark):
    df = spark.range(3000).select(
        F.when(c("id") % 3 == 0, F.lit("hot")).when(c("id") % 50 == 1, F.lit(None)).otherwise((c("id") % 97).cast("string")).alias("k"), ((c("id") * 7919) % 3000).alias("v")
    )
    plain = ranking.rank_within_group(df, ["k"], [c("v")])
    split = ranking.rank_split_groups(df, ["k"], F.floor(c("v") / 100), [c("v")])
    assert rows(split) == rows(plain.select("k", "v", "rn"))


def test_ranked_pivot_drops_the_rest(frame):
    df = frame([("a", i) for i in range(6)] + [("b", 9)], "k string, v int")
    assert rows(ranking.pivot_ranked(df, ["k"], [c("v")], "v", ["x", "y"])) == [("a", 0, 1), ("b", 9, None)]


def test_max_id_orders(frame):
    df = frame([("9",), ("10",)], "id string")
    assert df.agg(ranking.max_id(c("id"))).first()[0] == "9"
    assert df.agg(ranking.max_id(c("id"), text_order=False)).first()[0] == "10"


FAMILIES = {"price": ["price%"], "size": ["size_%", "height_%"]}


@pytest.mark.parametrize("repeat", [False, True])
def test_families_equal_plain_joins(frame, repeat):
    attributes = [("r1", "svc_1", "s"), ("r1", "price_1", "10"), ("r1", "size_1", "L"), ("r1", "price_2", "99"), ("r2", "svc_1", "t"), ("r2", "svc", "u"), ("r2", "price", "5"), ("r3", "svc_7", "z")]
    if repeat:
        attributes += [("r1", "price_x_1", "11"), ("r1", "height_1", None), ("r1", "size_1", "L")]
    df = frame(attributes, "owner_id string, name string, value string")
    base = df.where(c("name").like("svc%")).select(c("owner_id").alias("o"), F.regexp_extract("name", "_([^_]*)$", 1).alias("s"), c("value").alias("service"))
    out = eav.join_families(base, eav.families_by_suffix(df, "owner_id", "name", "value", FAMILIES), "o", "s", {"price": "p", "size": "z"})
    suffixed = df.withColumn("sfx", F.regexp_extract("name", "_([^_]*)$", 1))

    def side(name, family, out_name):
        found = suffixed.where(eav.any_like(c("name"), FAMILIES[family])).select(c("owner_id").alias(f"{name}o"), c("sfx").alias(f"{name}s"), c("value").alias(out_name))
        return found, (c("o") == c(f"{name}o")) & (c("s") == c(f"{name}s"))

    plain = base
    for name, family, out_name in (("a", "price", "p"), ("b", "size", "z")):
        right, on = side(name, family, out_name)
        plain = plain.join(right, on, "left")
    assert rows(out) == rows(plain.select("o", "s", "service", "p", "z"))


def test_unions(frame):
    a, b = frame([(1, "x"), (1, "x")], "i int, s string"), frame([("x", 1), ("y", 2)], "s string, i int")
    assert rows(sets.union_all(a, b)) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    assert rows(sets.union_distinct(a, frame([(1, "x"), (3, "z")], "other int, names string"))) == [(1, "x"), (3, "z")]


def test_text_keys_compare_as_at_the_source(frame):
    rows = frame([("R1R002", 1), ("r1r002", 2), ("R1R002 ", 3), ("R1R003", 4), (None, 5)], "k string, i int")
    listed = frame([("r1R002  ",), (None,)], "name string")

    def ids(df):
        return sorted(r["i"] for r in df.collect())

    assert ids(lookup.exclude_keys(rows, "k", listed.where("name is not null"), "name")) == [4]
    assert ids(lookup.keep_keys(rows, "k", listed, "name")) == [1, 2, 3]
    assert [(r["i"], r["f"]) for r in lookup.flag_keys(rows, "k", listed, "name", "f").orderBy("i").collect()] == [(1, True), (2, True), (3, True), (4, False), (5, False)]
    numbers = frame([(1,), (2,)], "i int")
    assert ids(lookup.exclude_keys(numbers, "i", frame([(1,)], "n int"), "n")) == [2]


def dictionary(frame, *rows):
    return frame(list(rows), "objecttypecode int, attributename string, langid int, attributevalue int, value string")


def test_code_map_and_the_join_give_the_same(frame):
    held = dictionary(frame, (1, "Kind", 1033, 1, "one"), (1, "kind", 1033, 2, None), (1, "kind", 1045, 1, "jeden"), (2, "kind", 1033, 3, "three"), (1, "kind", 1033, None, "no code"))
    rows = frame([(1, 1), (2, 2), (3, 3), (None, 1), (9, None)], "a int, b int")
    english, polish = ("KIND", 1, 1033), ("kind", 1, 1045)
    for how in ("left", "inner"):
        got = []
        for most in (100, 1):
            words = lookup.CodeMap(held, [english, polish], most)
            assert words.mapped == (most == 100)
            out = words.decode(rows, {"x": ("a", english), "y": ("b", polish)}, how)
            got.append(sorted(map(tuple, out.collect()), key=str))
            assert ("Join" in out._jdf.queryExecution().optimizedPlan().toString()) != words.mapped
        assert got[0] == got[1] and len(got[0]) == (5 if how == "left" else 1)
    twice = dictionary(frame, (1, "kind", 1033, 1, "one"), (1, "kind", 1033, 1, "uno"))
    words = lookup.CodeMap(twice, [english])
    assert not words.mapped and words.decode(rows, {"x": ("a", english)}).count() == 6
    none = lookup.CodeMap(dictionary(frame), [english])
    assert none.mapped and none.decode(rows, {"x": ("a", english)}).where("x is null").count() == 5


def test_distinct_of_wide_rows(spark, frame):
    names = ", ".join(f"c{i} string" for i in range(70))
    row = lambda k: tuple("v" if i == k else None for i in range(70))
    df = frame([row(k) for k in (0, 1, 1, 2, 69, None, None)], names)
    assert sorted(map(str, sets.distinct_wide(df).collect())) == sorted(map(str, df.distinct().collect()))
    odd = frame([(1.0, 0.0), (1.0, -0.0), (float("nan"), 1.0), (float("nan"), 1.0), (None, None)], "`a b` double, x double")
    assert sets.distinct_wide(odd).count() == odd.distinct().count() == 3
    assert sets.distinct_wide(odd.limit(0)).collect() == []
    # Different rows whose hashes agree both stay.
    import siftload.operators.sets as module

    class Equal:
        def __getattr__(self, name):
            return (lambda *_: F.lit(7).cast("long")) if name == "xxhash64" else getattr(F, name)

    real, module.F = module.F, Equal()
    try:
        assert sets.distinct_wide(df).count() == df.distinct().count() == 5
    finally:
        module.F = real
