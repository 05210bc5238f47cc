"""Projections, filters, joins, aggregates, windows, unions and load modes on the given tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import Star, query
from siftload.functions import codes, dates, numbers, text
from siftload.operators import eav, filters, lookup, ranking, rules, sets
from siftload.session import work_dir
from siftload.sinks import incremental, merge
from siftload.sinks.audit import RunAudit
from siftload.sinks.derived import DerivedTarget
from siftload.sinks.target import ParquetTarget
from siftload.sources.owned import owned_rows
from siftload.sources.staging import staged
from siftload.sources.tables import Tables

c = F.col

# Code dictionary of the checks: (objecttypecode, attributename, langid, attributevalue, value).
DICTIONARY = """(VALUES
 (1, 'Priority', 1033, 1, 'urgent'), (1, 'Priority', 1033, 2, 'high'), (1, 'Priority', 1033, 3, 'medium'),
 (1, 'Priority', 1045, 1, 'pilne'), (1, 'Priority', 1045, 2, 'wysokie'), (1, 'Priority', 1045, 4, 'inne'),
 (2, 'priority', 1033, 1, 'top'), (2, 'priority', 1033, 2, 'high'), (2, 'priority', 1033, 5, 'low'))"""
DICTIONARY_COLUMNS = "(objecttypecode, attributename, langid, attributevalue, value)"


def dictionary(s: Star) -> DataFrame:
    return s.spark.sql(f"SELECT * FROM {DICTIONARY} AS d{DICTIONARY_COLUMNS}")


def coded_orders(s: Star) -> DataFrame:
    return s.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("code"))


CODED = "(SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code FROM orders)"
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LINE_ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# ---------------------------------------------------------------- projections


@query("case_nested", """
SELECT o_orderkey, CASE WHEN k LIKE 'BIG%' THEN 'B:' || k WHEN k LIKE 'S%' THEN 'S' ELSE k END AS label
FROM (SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'BIG ' || o_orderstatus WHEN o_totalprice < 50000 THEN 'SMALL' ELSE o_orderpriority END AS k FROM orders)""")
def _(s):
    inner = F.when(c("o_totalprice") > 300000, F.concat(F.lit("BIG "), c("o_orderstatus"))).when(
        c("o_totalprice") < 50000, F.lit("SMALL")).otherwise(c("o_orderpriority"))
    k = c("k")
    outer = F.when(k.like("BIG%"), F.concat(F.lit("B:"), k)).when(k.like("S%"), F.lit("S")).otherwise(k)
    return s.orders.withColumn("k", inner).select("o_orderkey", outer.alias("label"))


@query("null_default", """
SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic, CASE WHEN quality IS NULL THEN ' ' ELSE source END AS source
FROM documents d LEFT JOIN labels USING (doc_id)""")
def _(s):
    return s.documents.select("doc_id", "source").join(s.labels, "doc_id", "left").select(
        "doc_id", numbers.number_or_zero(c("quality"), "int").alias("quality"), numbers.number_or_zero(c("toxic")).alias("toxic"),
        F.when(c("quality").isNull(), F.lit(" ")).otherwise(c("source")).alias("source"))


def ordered_keys(s):
    return s.lineitem.select("l_orderkey").distinct()


@query("presence_flag", """
SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_items
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey""")
def _(s):
    return s.orders.select("o_orderkey").join(ordered_keys(s), c("o_orderkey") == c("l_orderkey"), "left").select(
        "o_orderkey", codes.presence_flag(c("l_orderkey"), "Yes", "No").alias("has_items"))


@query("presence_matrix", """
WITH k AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT c_custkey, CASE WHEN a.user_id IS NULL AND b.user_id IS NULL AND d.user_id IS NULL AND e.user_id IS NULL THEN ''
 WHEN a.user_id IS NOT NULL AND b.user_id IS NULL AND d.user_id IS NULL AND e.user_id IS NULL THEN 'first'
 WHEN a.user_id IS NOT NULL AND b.user_id IS NOT NULL AND d.user_id IS NOT NULL AND e.user_id IS NOT NULL THEN 'all'
 WHEN a.user_id IS NOT NULL AND b.user_id IS NOT NULL AND d.user_id IS NULL AND e.user_id IS NOT NULL THEN 'mixed' ELSE 'other' END AS label
FROM customer LEFT JOIN k a ON a.user_id = c_custkey AND a.event_type = 'click' LEFT JOIN k b ON b.user_id = c_custkey AND b.event_type = 'view'
LEFT JOIN k d ON d.user_id = c_custkey AND d.event_type = 'purchase' LEFT JOIN k e ON e.user_id = c_custkey AND e.event_type = 'error'""")
def _(s):
    kinds = ["click", "view", "purchase", "error"]
    found = s.events.groupBy("user_id").agg(*[F.max(c("event_type") == k).alias(k) for k in kinds])
    flags = [F.coalesce(c(k), F.lit(False)) for k in kinds]
    label = codes.presence_label(
        {(False,) * 4: "", (True, False, False, False): "first", (True,) * 4: "all", (True, True, False, True): "mixed"}, flags, "other")
    return s.customer.select("c_custkey").join(found, c("c_custkey") == c("user_id"), "left").select("c_custkey", label.alias("label"))


@query("prefer_first_source", """
SELECT o_orderkey, coalesce(r.p, a.p, 0.0) AS price, CASE WHEN r.p IS NULL AND a.p IS NULL THEN '' WHEN r.p IS NOT NULL THEN 'R' ELSE 'A' END AS source
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_extendedprice) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON r.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, min(l_extendedprice) AS p FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a ON a.l_orderkey = o_orderkey""")
def _(s):
    both = s.lineitem.where(c("l_returnflag").isin("R", "A")).groupBy("l_orderkey").agg(
        F.min(F.when(c("l_returnflag") == "R", c("l_extendedprice"))).alias("r"),
        F.min(F.when(c("l_returnflag") == "A", c("l_extendedprice"))).alias("a"))
    return s.orders.select("o_orderkey").join(both, c("o_orderkey") == c("l_orderkey"), "left").select(
        "o_orderkey", codes.prefer_first(0.0, c("r"), c("a")).alias("price"),
        codes.classify([(c("r").isNotNull(), "R"), (c("a").isNotNull(), "A")]).alias("source"))


@query("rule_classify", f"""
SELECT {LINE_SQL}, CASE
 WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'done - returned' WHEN o_orderstatus = 'F' AND l_linestatus = 'F' THEN 'done'
 WHEN o_orderstatus = 'F' THEN 'done - open line' WHEN l_discount > 0.08 OR l_tax = 0 OR l_quantity NOT IN (1, 2, 3) AND o_orderpriority = '1-URGENT' THEN 'special'
 WHEN o_orderstatus NOT IN ('F', 'P') AND l_linestatus = 'O' AND (l_returnflag IN ('A', 'N') OR l_quantity > 40) THEN 'in progress'
 WHEN o_orderstatus = 'P' AND l_returnflag = 'N' THEN 'partial' WHEN o_orderstatus = 'P' THEN 'partial - other' WHEN l_quantity > 10 THEN 'large' ELSE '' END AS progress
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(s):
    done, open_ = c("o_orderstatus") == "F", ~c("o_orderstatus").isin("F", "P")
    listed = [
        (done & (c("l_returnflag") == "R"), "done - returned"),
        (done & (c("l_linestatus") == "F"), "done"),
        (done, "done - open line"),
        ((c("l_discount") > 0.08) | (c("l_tax") == 0) | (~c("l_quantity").isin(1, 2, 3) & (c("o_orderpriority") == "1-URGENT")), "special"),
        (open_ & (c("l_linestatus") == "O") & (c("l_returnflag").isin("A", "N") | (c("l_quantity") > 40)), "in progress"),
        ((c("o_orderstatus") == "P") & (c("l_returnflag") == "N"), "partial"),
        (c("o_orderstatus") == "P", "partial - other"),
        (c("l_quantity") > 10, "large"),
    ]
    return s.lineitem.join(s.orders, c("o_orderkey") == c("l_orderkey")).select(*LINE_KEYS, codes.classify(listed).alias("progress"))


@query("rule_classify_barriers", f"""
SELECT {LINE_SQL}, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND (l_quantity < 5 AND l_discount < 0.03) OR l_tax > 0.07 THEN 'Barrier - mixed'
 WHEN l_returnflag NOT IN ('A', 'N') AND l_discount > 0.05 THEN 'Barrier - discount' WHEN l_quantity > 45 OR l_linestatus = 'F' AND l_tax = 0 THEN 'Barrier - other' ELSE '' END AS barrier
FROM lineitem""")
def _(s):
    returned = c("l_returnflag") == "R"
    listed = [
        ((returned & (c("l_linestatus") == "O") & (c("l_quantity") < 5) & (c("l_discount") < 0.03)) | (c("l_tax") > 0.07), "Barrier - mixed"),
        (~c("l_returnflag").isin("A", "N") & (c("l_discount") > 0.05), "Barrier - discount"),
        ((c("l_quantity") > 45) | ((c("l_linestatus") == "F") & (c("l_tax") == 0)), "Barrier - other"),
    ]
    return s.lineitem.select(*LINE_KEYS, codes.classify(listed).alias("barrier"))


PROGRESS_FACTS = ("done", "partial", "returned", "kept", "line_open", "large", "cheap", "urgent")
PROGRESS_RULES = [
    ("done - returned", {"done": True, "returned": True}),
    ("done", {"done": True, "line_open": False}),
    ("done - open line", {"done": True}),
    *rules.any_of("special", {}, {"cheap": True}, {"large": False, "urgent": True}),
    *rules.any_of("in progress", {"done": False, "partial": False, "line_open": True}, {"kept": True}, {"large": True}),
    ("partial", {"partial": True, "kept": True}),
    ("partial - other", {"partial": True}),
    ("large", {"large": True}),
]


@query("rule_classify_table", f"""
SELECT {LINE_SQL}, CASE
 WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'done - returned' WHEN o_orderstatus = 'F' AND l_linestatus <> 'O' THEN 'done' WHEN o_orderstatus = 'F' THEN 'done - open line'
 WHEN l_discount > 0.08 OR l_quantity <= 40 AND o_orderpriority = '1-URGENT' THEN 'special'
 WHEN o_orderstatus NOT IN ('F', 'P') AND l_linestatus = 'O' AND (l_returnflag = 'N' OR l_quantity > 40) THEN 'in progress'
 WHEN o_orderstatus = 'P' AND l_returnflag = 'N' THEN 'partial' WHEN o_orderstatus = 'P' THEN 'partial - other' WHEN l_quantity > 40 THEN 'large' ELSE '' END AS progress
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(s):
    """The rules are rows (position, mask, label), written out and read again."""
    facts = {
        "done": c("o_orderstatus") == "F", "partial": c("o_orderstatus") == "P", "returned": c("l_returnflag") == "R", "kept": c("l_returnflag") == "N",
        "line_open": c("l_linestatus") == "O", "large": c("l_quantity") > 40, "cheap": c("l_discount") > 0.08, "urgent": c("o_orderpriority") == "1-URGENT",
    }
    stored = rules.RuleTable.of_rows(PROGRESS_FACTS, rules.RuleTable(PROGRESS_FACTS, PROGRESS_RULES).rows())
    lines = s.lineitem.join(s.orders, c("o_orderkey") == c("l_orderkey"))
    return stored.classify(lines, facts, "progress").select(*LINE_KEYS, "progress")


@query("concat_name", "SELECT n_nationkey, n_name || ' ' || r_name AS full_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'")
def _(s):
    r = s.region.where(c("r_name") != "ASIA")
    return s.nation.join(r, c("n_regionkey") == c("r_regionkey"), "left").select("n_nationkey", text.concat_name(c("n_name"), c("r_name")).alias("full_name"))


# ---------------------------------------------------------------- filters

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


@query("filter_compare", f"{ORDER_SQL} WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' AND o_totalprice >= 1000 AND o_totalprice < 300000")
def _(s):
    return s.orders.where((c("o_orderstatus") == "O") & (c("o_orderpriority") != "5-LOW") & (c("o_totalprice") >= 1000) & (c("o_totalprice") < 300000)).select(*ORDER_COLUMNS)


@query("filter_date_cutoff", f"{ORDER_SQL} WHERE o_orderdate >= TIMESTAMP '1999-06-01'")
def _(s):
    return s.orders.where(c("o_orderdate") >= dates.ntz("1999-06-01")).select(*ORDER_COLUMNS)


@query("filter_in_list", "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#13') AND p_size IN (1, 2, 3, 5, 8, 13)")
def _(s):
    return s.part.where(codes.is_in(c("p_brand"), ["Brand#1", "Brand#7", "Brand#13"]) & codes.is_in(c("p_size"), [1, 2, 3, 5, 8, 13])).select("p_partkey", "p_brand")


@query("filter_not_in_list", "SELECT o_orderkey, user_id FROM orders LEFT JOIN (SELECT DISTINCT user_id FROM events) ON user_id = o_custkey WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")
def _(s):
    t = s.tables("supplier")
    seen = s.events.select("user_id").distinct()
    joined = s.orders.select("o_orderkey", "o_custkey").join(seen, c("o_custkey") == c("user_id"), "left")
    return lookup.exclude_keys(joined, "user_id", t.lookup("supplier"), "s_suppkey").select("o_orderkey", "user_id")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_name LIKE '%idge%' OR p_type LIKE 'S_A%'")
def _(s):
    return s.part.where(c("p_name").like("red%") | c("p_name").like("%bolt") | c("p_name").like("%idge%") | c("p_type").like("S_A%")).select("p_partkey", "p_name")


@query("filter_between", f"SELECT {LINE_SQL}, l_shipdate FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-03-31'")
def _(s):
    return s.lineitem.where(c("l_shipdate").between(dates.ntz("1996-01-01"), dates.ntz("1997-03-31"))).select(*LINE_KEYS, "l_shipdate")


@query("filter_or_null", "SELECT o_orderkey, l_shipdate FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '2000-01-01' OR l_shipdate IS NULL")
def _(s):
    lines = s.lineitem.select("l_orderkey", "l_shipdate")
    joined = s.orders.select("o_orderkey").join(lines, c("o_orderkey") == c("l_orderkey"), "left")
    return joined.where(filters.or_null(c("l_shipdate") >= dates.ntz("2000-01-01"), c("l_shipdate"))).select("o_orderkey", "l_shipdate")


@query("filter_not_null_any", """
SELECT c_custkey, s_name, user_id FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN (SELECT DISTINCT user_id FROM events) ON user_id = c_custkey
WHERE s_name IS NOT NULL OR user_id IS NOT NULL""")
def _(s):
    joined = s.customer.select("c_custkey").join(s.supplier.select("s_suppkey", "s_name"), c("s_suppkey") == c("c_custkey"), "left").join(
        s.events.select("user_id").distinct(), c("user_id") == c("c_custkey"), "left")
    return joined.where(filters.any_not_null(c("s_name"), c("user_id"))).select("c_custkey", "s_name", "user_id")


@query("filter_rolling_days", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def _(s):
    return s.events.where(filters.within_days(c("ts"), "2024-01-31", 7)).select("event_id", "ts")


@query("filter_function_pred", f"SELECT {LINE_SQL} FROM lineitem WHERE year(l_shipdate) >= 2000")
def _(s):
    return s.lineitem.where(dates.from_year(c("l_shipdate"), 2000)).select(*LINE_KEYS)


@query("filter_implicit_cast", "SELECT p_partkey, p_size FROM part WHERE p_size = CAST('5' AS INTEGER)")
def _(s):
    return s.part.where(filters.equals_text_number(c("p_size"), "5")).select("p_partkey", "p_size")


SUPERVISED = "(SELECT s_suppkey AS id, s_name AS nm, CAST(floor(s_suppkey / 5) AS BIGINT) AS boss FROM supplier)"


def supervised(s: Star) -> DataFrame:
    return s.supplier.select("s_suppkey", "s_name", F.floor(c("s_suppkey") / 5).alias("boss"))


@query("filter_two_level_scope", f"""
SELECT l_orderkey, l_suppkey FROM lineitem JOIN {SUPERVISED} p ON p.id = l_suppkey LEFT JOIN {SUPERVISED} u1 ON u1.id = p.boss LEFT JOIN {SUPERVISED} u2 ON u2.id = u1.boss
WHERE u1.nm IN (SELECT s_name FROM supplier WHERE s_suppkey % 3 = 1) OR u2.nm IN (SELECT s_name FROM supplier WHERE s_suppkey % 3 = 1)""")
def _(s):
    allowed = s.supplier.where("s_suppkey % 3 = 1").select("s_name")
    people = supervised(s)
    scope = lookup.hierarchy_two_up(people, people, "s_suppkey", "boss", "s_name")
    scope = lookup.flag_keys(lookup.flag_keys(scope, "up1_name", allowed, "s_name", "in1"), "up2_name", allowed, "s_name", "in2")
    return s.lineitem.select("l_orderkey", "l_suppkey").join(scope.where("in1 or in2").select("s_suppkey"), c("l_suppkey") == c("s_suppkey"), "left_semi")


@query("filter_whitelist_or_date", f"{ORDER_SQL} WHERE o_orderdate >= TIMESTAMP '2000-06-01' OR o_orderkey IN (3, 77, 1204, 9999)")
def _(s):
    return s.orders.where(filters.listed_or(c("o_orderdate") >= dates.ntz("2000-06-01"), c("o_orderkey"), [3, 77, 1204, 9999])).select(*ORDER_COLUMNS)


@query("filter_ci_equality", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = lower('Building')")
def _(s):
    return s.customer.where(text.equals_ignore_case(c("c_mktsegment"), F.lit("Building "))).select("c_custkey", "c_mktsegment")


# ---------------------------------------------------------------- joins


@query("join_inner", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey")
def _(s):
    return s.orders.join(s.customer, c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("join_left", "SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def _(s):
    return s.orders.join(s.lineitem, c("o_orderkey") == c("l_orderkey"), "left").select("o_orderkey", "l_partkey", "l_quantity")


@query("join_chain", """
SELECT r_name, n_name, c_custkey, o_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def _(s):
    places = s.nation.join(s.region, c("n_regionkey") == c("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    buyers = s.customer.select("c_custkey", "c_nationkey").join(places, c("c_nationkey") == c("n_nationkey"))
    bought = s.orders.select("o_orderkey", "o_custkey").join(buyers, c("o_custkey") == c("c_custkey"))
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice").join(bought, c("l_orderkey") == c("o_orderkey")).select(
        "r_name", "n_name", "c_custkey", "o_orderkey", "l_linenumber", "l_extendedprice")


@query("option_set_decode", f"""
SELECT o_orderkey, a.value AS priority, b.value AS priority_pl FROM {CODED} JOIN {DICTIONARY} a{DICTIONARY_COLUMNS}
 ON a.attributevalue = code AND a.objecttypecode = 1 AND a.langid = 1033 AND a.attributename = 'Priority'
LEFT JOIN {DICTIONARY} b{DICTIONARY_COLUMNS} ON b.attributevalue = code AND b.objecttypecode = 1 AND b.langid = 1045 AND lower(b.attributename) = 'priority'""")
def _(s):
    d = dictionary(s)
    out = lookup.decode(coded_orders(s), d, "code", "priority", attribute="priority", entity=1, lang=1033, how="inner")
    return lookup.decode(out, d, "code", "priority_pl", attribute="Priority", entity=1, lang=1045).drop("code")


@query("join_missing_dict_key", f"""
SELECT DISTINCT o_orderkey, d.value AS priority FROM {CODED} LEFT JOIN {DICTIONARY} d{DICTIONARY_COLUMNS}
 ON d.attributevalue = code AND d.langid = 1033 AND lower(d.attributename) = 'priority'""")
def _(s):
    return lookup.decode(coded_orders(s), dictionary(s), "code", "priority", attribute="priority", lang=1033).drop("code").distinct()


@query("join_role_playing", f"""
SELECT {LINE_SQL}, cn.n_name AS buyer_n_name, sn.n_name AS seller_n_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey""")
def _(s):
    nations = s.tables("nation").lookup("nation")
    buyers = lookup.join_role(s.customer.select("c_custkey", "c_nationkey"), nations, "c_nationkey", "buyer", "n_nationkey", ["n_name"])
    sellers = lookup.join_role(s.supplier.select("s_suppkey", "s_nationkey"), nations, "s_nationkey", "seller", "n_nationkey", ["n_name"])
    orders = s.orders.select("o_orderkey", "o_custkey").join(buyers, c("o_custkey") == c("c_custkey"))
    return s.lineitem.select(*LINE_KEYS).join(orders, c("l_orderkey") == c("o_orderkey")).join(sellers, c("l_suppkey") == c("s_suppkey")).select(
        *LINE_KEYS, "buyer_n_name", "seller_n_name")


@query("join_hierarchy_2", f"""
SELECT l_orderkey, l_linenumber, l_suppkey, u1.nm AS manager, u2.nm AS upper_manager FROM lineitem LEFT JOIN {SUPERVISED} p ON p.id = l_suppkey
LEFT JOIN {SUPERVISED} u1 ON u1.id = p.boss LEFT JOIN {SUPERVISED} u2 ON u2.id = u1.boss""")
def _(s):
    people = supervised(s)
    up = lookup.hierarchy_two_up(people, people, "s_suppkey", "boss", "s_name").select(
        "s_suppkey", c("up1_name").alias("manager"), c("up2_name").alias("upper_manager"))
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(up, c("l_suppkey") == c("s_suppkey"), "left").drop("s_suppkey")


@query("join_parent_child", """
SELECT p.p_partkey AS parent_key, k.p_partkey AS child_key, k.p_name AS child_name FROM part p JOIN part k ON CAST(floor(k.p_partkey / 5) AS BIGINT) = p.p_partkey""")
def _(s):
    children = s.part.select(F.floor(c("p_partkey") / 5).alias("parent"), c("p_partkey").alias("child_key"), c("p_name").alias("child_name"))
    return s.part.select(c("p_partkey").alias("parent_key")).join(children, c("parent") == c("parent_key")).select("parent_key", "child_key", "child_name")


@query("join_bridge", "SELECT p_name, s_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey")
def _(s):
    return s.lineitem.select("l_partkey", "l_suppkey").join(s.part, c("p_partkey") == c("l_partkey")).join(
        s.supplier, c("s_suppkey") == c("l_suppkey")).select("p_name", "s_name")


@query("join_polymorphic", """
SELECT event_id, coalesce(s_name, c_name) AS name FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN supplier ON s_suppkey = user_id""")
def _(s):
    return s.events.select("event_id", "user_id").join(s.customer.select("c_custkey", "c_name"), c("c_custkey") == c("user_id"), "left").join(
        s.supplier.select("s_suppkey", "s_name"), c("s_suppkey") == c("user_id"), "left").select("event_id", F.coalesce("s_name", "c_name").alias("name"))


@query("join_case_key", """
SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = CASE WHEN c_nationkey = 0 THEN CAST(c_custkey % 25 AS INTEGER) ELSE c_nationkey END""")
def _(s):
    key = F.when(c("c_nationkey") == 0, (c("c_custkey") % 25).cast("int")).otherwise(c("c_nationkey"))
    return s.customer.select("c_custkey", key.alias("k")).join(s.nation, c("k") == c("n_nationkey"), "left").select("c_custkey", "n_name")


@query("join_priority_fallback", """
SELECT c_custkey, o_orderkey, o_totalprice, o_orderstatus FROM customer
LEFT JOIN (SELECT o_custkey AS k, max(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.k = c_custkey
LEFT JOIN (SELECT o_custkey AS k, max(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) o ON o.k = c_custkey
LEFT JOIN (SELECT o_custkey AS k, max(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) p ON p.k = c_custkey
LEFT JOIN orders ON o_orderkey = CASE WHEN f.m IS NOT NULL THEN f.m WHEN o.m IS NOT NULL THEN o.m ELSE p.m END""")
def _(s):
    best = s.orders.groupBy("o_custkey").agg(
        F.coalesce(*[F.max(F.when(c("o_orderstatus") == k, c("o_orderkey"))) for k in ("F", "O", "P")]).alias("best"))
    chosen = s.customer.select("c_custkey").join(best, c("c_custkey") == c("o_custkey"), "left").select("c_custkey", "best")
    return chosen.join(s.orders.drop("o_custkey"), c("best") == c("o_orderkey"), "left").select("c_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("join_derived_agg", """
SELECT c_custkey, last_order FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(s):
    last = s.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    return s.customer.select("c_custkey").join(last, c("c_custkey") == c("o_custkey"), "left").select("c_custkey", "last_order")


FIRST_ORDERS = """
SELECT DISTINCT o.o_custkey, o.o_orderkey, o.o_orderdate FROM orders o
JOIN (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY 1) m ON m.o_custkey = o.o_custkey AND m.d = o.o_orderdate"""


@query("join_argmin_back", FIRST_ORDERS)
def _(s):
    return ranking.all_first_per_group(s.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [c("o_orderdate")]).distinct()


@query("join_demoted_left", """
SELECT o_orderkey, l_linenumber, p_name FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""")
def _(s):
    lines = s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return s.orders.select("o_orderkey").join(lines, c("o_orderkey") == c("l_orderkey")).join(s.part, c("p_partkey") == c("l_partkey")).select(
        "o_orderkey", "l_linenumber", "p_name")


@query("join_latest_row", f"""
SELECT o_orderkey, l_partkey, l_shipdate FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey, l_shipdate,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, {', '.join(LINE_ORDER[:-1])}) AS rn FROM lineitem) ON l_orderkey = o_orderkey AND rn = 1""")
def _(s):
    latest = ranking.first_per_group(s.lineitem, ["l_orderkey"], [c("l_shipdate").desc(), *[c(k) for k in LINE_ORDER[:-1]]])
    return s.orders.select("o_orderkey").join(latest.select("l_orderkey", "l_partkey", "l_shipdate"), c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")


@query("join_attr_by_name", """
SELECT k.conv_id, u.text AS asked, a.text AS answered FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN conversations u ON u.conv_id = k.conv_id AND u.role = 'user' LEFT JOIN conversations a ON a.conv_id = k.conv_id AND a.role LIKE 'assist%'""")
def _(s):
    base = s.conversations.select("conv_id").distinct()
    asked = eav.join_by_name(base, s.conversations, "conv_id", "conv_id", c("role") == "user", "text", "asked")
    return eav.join_by_name(asked, s.conversations, "conv_id", "conv_id", c("role").like("assist%"), "text", "answered")


@query("join_by_owner", """
SELECT event_id, user_id, event_type, value FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') OR user_id % 10 = 3""")
def _(s):
    wanted = s.customer.where(c("c_mktsegment") == "BUILDING").select(c("c_custkey").alias("id")).unionByName(
        s.events.where(c("user_id") % 10 == 3).select(c("user_id").alias("id")))
    with owned_rows(s.events.select("event_id", "user_id", "event_type", "value"), "user_id", rows_per_bucket=500) as events:
        return staged(events.of(wanted, "id"))


NAMED_EVENTS = "(SELECT user_id, event_type || '_x_' || (event_id % 97) AS name, value FROM events)"


@query("join_attr_by_suffix", f"""
WITH e AS (SELECT user_id, name, list_last(string_split(name, '_')) AS sfx, value FROM {NAMED_EVENTS})
SELECT b.user_id, b.name, b.value AS clicked, v.value AS viewed, x.value AS failed FROM e b
LEFT JOIN e v ON v.user_id = b.user_id AND v.sfx = b.sfx AND (v.name LIKE 'view%' OR v.name LIKE 'purch%')
LEFT JOIN e x ON x.user_id = b.user_id AND x.sfx = b.sfx AND x.name LIKE 'error_%' WHERE b.name LIKE 'click%'""")
def _(s):
    named = s.events.select("user_id", F.concat(c("event_type"), F.lit("_x_"), c("event_id") % 97).alias("name"), "value")
    base = named.where(c("name").like("click%")).select("user_id", "name", c("value").alias("clicked"), text.suffix_after_underscore(c("name")).alias("sfx"))
    families = {"seen": ["view%", "purch%"], "failed": ["error_%"]}
    by_suffix = eav.families_by_suffix(named, "user_id", "name", "value", families)
    return eav.join_families(base, by_suffix, "user_id", "sfx", {"seen": "viewed", "failed": "failed"}).drop("sfx")


@query("join_or_like_residual", f"""
SELECT {LINE_SQL}, p_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND (p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_type LIKE 'PROMO%')""")
def _(s):
    picked = s.part.where(eav.any_like(c("p_name"), ["red%", "%bolt"]) | c("p_type").like("PROMO%")).select("p_partkey", "p_name")
    return s.lineitem.select(*LINE_KEYS).join(picked, c("l_partkey") == c("p_partkey"), "left").drop("p_partkey")


@query("join_filter_in_on", "SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'")
def _(s):
    returned = s.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")
    return s.orders.select("o_orderkey").join(returned, c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")


@query("join_compare_flag", """
SELECT DISTINCT o_orderkey, CASE WHEN c_nationkey = s_nationkey THEN 'No' ELSE 'Yes' END AS three_sided
FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey""")
def _(s):
    buyers = s.orders.select("o_orderkey", "o_custkey").join(s.customer.select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey"))
    sellers = s.lineitem.select("l_orderkey", "l_suppkey").join(s.supplier.select("s_suppkey", "s_nationkey"), c("l_suppkey") == c("s_suppkey")).select(
        "l_orderkey", "s_nationkey").distinct()
    flag = F.when(c("c_nationkey") == c("s_nationkey"), F.lit("No")).otherwise(F.lit("Yes"))
    return buyers.join(sellers, c("o_orderkey") == c("l_orderkey")).select("o_orderkey", flag.alias("three_sided")).distinct()


DEFINITIONS = "(VALUES ('N', 'd1'), ('R', 'd2'), ('A', 'd3'))"
INDEXED = "(VALUES ('d1', '1', '12 months'), ('d1', '2', '24 months'), ('d2', '1', 'fixed'), ('d2', '3', 'open'))"


@query("join_value_dictionary", f"""
SELECT {LINE_SQL}, label FROM lineitem JOIN {DEFINITIONS} d(flag, definition) ON d.flag = l_returnflag
JOIN {INDEXED} v(of_definition, idx, label) ON v.of_definition = d.definition AND v.idx = CAST(l_linenumber AS VARCHAR)""")
def _(s):
    definitions = s.spark.sql(f"SELECT * FROM {DEFINITIONS} AS d(flag, definition)")
    values = s.spark.sql(f"SELECT * FROM {INDEXED} AS v(of_definition, idx, label)")
    lines = s.lineitem.select(*LINE_KEYS, "l_returnflag", c("l_linenumber").cast("string").alias("idx"))
    lines = lines.join(definitions, c("l_returnflag") == c("flag"))
    return lookup.decode_by_definition(
        lines.withColumnRenamed("definition", "def"), definitions, values, definition="def", index="idx", out="label",
        definition_key="definition", values_definition="of_definition", values_index="idx", values_label="label").select(*LINE_KEYS, "label")


@query("join_redundant_self", """
SELECT o_orderkey, coalesce(b.c_name, a.c_name) AS name FROM orders JOIN customer a ON a.c_custkey = o_custkey LEFT JOIN customer b ON b.c_custkey = a.c_custkey""")
def _(s):
    return s.orders.select("o_orderkey", "o_custkey").join(s.customer, c("c_custkey") == c("o_custkey")).select("o_orderkey", c("c_name").alias("name"))


@query("join_duplicated_lookup", """
SELECT d.doc_id, CASE WHEN o.quality IS NOT NULL THEN CAST(o.quality AS VARCHAR) WHEN t1.toxic IS NULL AND t.toxic IS NOT NULL THEN 'x' ELSE '' END AS margin
FROM documents d LEFT JOIN labels t ON t.doc_id = d.doc_id AND t.toxic = 1 LEFT JOIN labels t1 ON t1.doc_id = d.doc_id AND t1.toxic = 1
LEFT JOIN labels o ON o.doc_id = d.doc_id AND o.toxic = 0""")
def _(s):
    old = s.labels.where("toxic = 0").select("doc_id", c("quality").cast("string").alias("old"))
    return s.documents.select("doc_id").join(old, "doc_id", "left").select("doc_id", codes.prefer_first("", c("old")).alias("margin"))


# ---------------------------------------------------------------- aggregates and windows


@query("agg_max", "SELECT o_custkey, max(o_totalprice) AS top_price, max(CAST(o_orderkey AS VARCHAR)) AS top_text_id, CAST(max(o_orderkey) AS VARCHAR) AS top_number_id FROM orders GROUP BY 1")
def _(s):
    key = c("o_orderkey").cast("string")
    return s.orders.groupBy("o_custkey").agg(
        F.max("o_totalprice").alias("top_price"), ranking.max_id(key).alias("top_text_id"), ranking.max_id(key, text_order=False).alias("top_number_id"))


@query("agg_min", "SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1")
def _(s):
    return s.lineitem.where(c("l_returnflag").isin("A", "R")).groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))


@query("agg_sum_conditional", """
SELECT o_custkey, round(sum(CASE WHEN l_returnflag = 'R' AND l_tax <> 0 THEN l_tax WHEN l_linestatus = 'F' THEN l_discount * l_extendedprice / 100 ELSE l_tax * l_quantity / 100 END), 2) AS margin,
 round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END), 2) AS revenue, sum(l_quantity) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def _(s):
    margin = numbers.margin_formula(F.when(c("l_returnflag") == "R", c("l_tax")), c("l_linestatus") == "F", c("l_discount"), c("l_extendedprice"), c("l_tax"), c("l_quantity"))
    return s.lineitem.join(s.orders.select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey")).groupBy("o_custkey").agg(
        F.round(F.sum(margin), 2).alias("margin"), F.round(F.sum(F.when(c("l_linestatus") == "F", c("l_extendedprice")).otherwise(0.0)), 2).alias("revenue"),
        F.sum("l_quantity").alias("quantity"))


@query("agg_group_by_expr", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%d') AS order_day, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS band,
 count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1, 2, 3""")
def _(s):
    shaped = s.orders.select(
        dates.year_of(c("o_orderdate")).cast("bigint").alias("order_year"), dates.date_to_text(dates.shift_hours_fixed(c("o_orderdate"))).alias("order_day"),
        codes.classify([(c("o_totalprice") > 250000, "high")], "low").alias("band"), "o_totalprice")
    return shaped.groupBy("order_year", "order_day", "band").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))


@query("agg_pivot_ranked", f"""
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem)
SELECT l_orderkey, max(CASE WHEN rn = 1 THEN l_partkey END) AS part_1, max(CASE WHEN rn = 2 THEN l_partkey END) AS part_2,
 max(CASE WHEN rn = 3 THEN l_partkey END) AS part_3, max(CASE WHEN rn = 4 THEN l_partkey END) AS part_4 FROM r GROUP BY 1""")
def _(s):
    return ranking.pivot_ranked(s.lineitem, ["l_orderkey"], [c(k) for k in LINE_ORDER], "l_partkey", ["part_1", "part_2", "part_3", "part_4"])


@query("eav_pivot", """
SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS clicked, max(CASE WHEN event_type = 'view' THEN value END) AS viewed,
 max(CASE WHEN event_type = 'error' THEN value END) AS failed FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1""")
def _(s):
    return eav.eav_pivot(s.events, ["user_id"], "event_type", "value", {"click": "clicked", "view": "viewed", "error": "failed"})


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def _(s):
    return s.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@query("distinct_after_group", "SELECT DISTINCT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey")
def _(s):
    return s.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def _(s):
    return s.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("rank_within_group", f"""
SELECT {LINE_SQL}, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS INTEGER) AS rn FROM lineitem""")
def _(s):
    return ranking.rank_within_group(s.lineitem, ["l_orderkey"], [c(k) for k in LINE_ORDER]).select(*LINE_KEYS, "rn")


@query("rank_split_groups", f"""
SELECT {LINE_SQL}, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY {', '.join(LINE_ORDER)}, l_orderkey) AS INTEGER) AS rn FROM lineitem""")
def _(s):
    order = [*[c(k) for k in LINE_ORDER], c("l_orderkey")]
    numbered = ranking.rank_split_groups(s.lineitem, ["l_returnflag"], F.floor(c("l_partkey") / 500), order)
    return numbered.select(*LINE_KEYS, "rn")


@query("latest_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(s):
    latest = ranking.first_per_group(s.orders, ["o_custkey"], [c("o_orderdate").desc(), c("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate")


# ---------------------------------------------------------------- unions and stages


@query("union_all", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def _(s):
    return sets.union_all(s.customer.select(c("c_name").alias("name"), c("c_acctbal").alias("balance")),
                          s.supplier.select(c("s_acctbal").alias("balance"), c("s_name").alias("name")))


@query("union_distinct", "SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier")
def _(s):
    return sets.union_distinct(s.customer.select(c("c_nationkey").alias("nation"), c("c_mktsegment").alias("label")),
                               s.supplier.select("s_nationkey", F.lit("supplier").alias("kind")))


@query("cte_stage", """
WITH ranked AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_totalprice END) AS first_price, max(CASE WHEN rn = 2 THEN o_totalprice END) AS second_price FROM ranked GROUP BY 1""")
def _(s):
    return ranking.pivot_ranked(s.orders, ["o_custkey"], [c("o_totalprice").desc(), c("o_orderkey")], "o_totalprice", ["first_price", "second_price"])


@query("derived_table", """
SELECT c_mktsegment, n_orders, count(*) AS customers FROM customer JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1, 2""")
def _(s):
    per_customer = s.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return s.customer.join(per_customer, c("c_custkey") == c("o_custkey")).groupBy("c_mktsegment", "n_orders").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- scans, sinks, load modes


@query("scan_table", "SELECT c_custkey, c_name FROM customer")
def _(s):
    return s.tables("customer")["customer"].select("c_custkey", "c_name")


@query("scan_multi_namespace", "SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def _(s):
    t = Tables().register_namespace("crm", s.tables("customer")).register_namespace("geo", s.tables("nation"))
    return t["crm.customer"].join(t.lookup("geo.nation"), c("c_nationkey") == c("n_nationkey")).select("c_custkey", "n_name")


def new_target(s: Star, **how) -> ParquetTarget:
    return ParquetTarget(s.spark, work_dir(s.spark) + "/target", **how)


@query("sink_append_batched", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(s):
    target = new_target(s)
    target.append(s.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name")))
    target.append(s.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name")))
    return target.read()


@query("sink_full_refresh", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(s):
    target = new_target(s)
    target.full_refresh(s.customer.select("c_custkey", "c_name", F.lit(0.0).alias("c_acctbal")))
    target.full_refresh(s.customer.select("c_custkey", "c_name", "c_acctbal"))
    return target.read()


@query("sink_replace_window", """
SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""")
def _(s):
    start = c("o_orderdate") >= dates.ntz("1999-01-01")
    rows = s.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    target = new_target(s)
    target.full_refresh(rows)
    target.replace_window(rows.where(start).withColumn("o_totalprice", c("o_totalprice") * 2), start | c("o_orderdate").isNull())
    return target.read()


@query("sink_replace_partitions", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN 'new' ELSE 'old' END AS tag FROM orders""")
def _(s):
    rows = s.orders.select(F.year("o_orderdate").alias("y"), "o_orderkey", F.lit("old").alias("tag"))
    target = new_target(s, partition_by=["y"])
    target.full_refresh(rows)
    target.replace_partitions(rows.where("y >= 2000").withColumn("tag", F.lit("new")))
    return target.read()


@query("merge_upsert", """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 200 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def _(s):
    target = s.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    changed = s.customer.where("c_mktsegment = 'BUILDING'")
    rows = [changed.select("c_custkey", "c_name", (c("c_acctbal") + add).alias("c_acctbal"), F.lit(seq).alias("seq")) for seq, add in ((1, 100), (2, 200))]
    added = s.supplier.select((-1 - c("s_suppkey")).alias("c_custkey"), c("s_name").alias("c_name"), c("s_acctbal").alias("c_acctbal"), F.lit(1).alias("seq"))
    return merge.merge_upsert(target, sets.union_all(*rows, added), ["c_custkey"], update=["c_name", "c_acctbal"], order=["seq"])


@query("merge_upsert_partitioned", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders
UNION ALL SELECT -1 - c_custkey, c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END FROM customer""")
def _(s):
    """Rows of the null partition are kept, updated and added like those of any other."""
    rows = s.orders.select(
        c("o_orderkey").alias("id"), c("o_totalprice").alias("price"), F.when(c("o_orderstatus") != "P", c("o_orderstatus")).alias("status")
    )
    target = new_target(s, partition_by=["status"])
    target.full_refresh(rows)
    changed = rows.where("id % 3 = 0").select("id", (c("price") + 100).alias("price"), "status")
    added = s.customer.select(
        (-1 - c("c_custkey")).alias("id"), c("c_acctbal").alias("price"), F.when(c("c_mktsegment") != "BUILDING", c("c_mktsegment")).alias("status")
    )
    target.merge(sets.union_all(changed, added), ["id"], update=["price"], insert_only=["status"])
    return target.read()


@query("merge_insert_only_cols", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END AS o_orderdate, o_totalprice + 1 AS o_totalprice FROM orders""")
def _(s):
    rows = s.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    source = rows.select("o_orderkey", dates.add_days(c("o_orderdate")).alias("o_orderdate"), (c("o_totalprice") + 1).alias("o_totalprice"))
    return merge.merge_upsert(rows.where(c("o_orderdate") < dates.ntz("2000-01-01")), source, ["o_orderkey"], update=["o_totalprice"], insert_only=["o_orderdate"])


@query("merge_constant_flag", "SELECT c_custkey, upper(c_name) AS c_name, 1 AS active FROM customer WHERE c_mktsegment = 'HOUSEHOLD' UNION ALL SELECT c_custkey, c_name, 0 FROM customer WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')")
def _(s):
    target = s.customer.where("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_name", F.lit(0).alias("active"))
    source = s.customer.where("c_mktsegment = 'HOUSEHOLD'").select("c_custkey", F.upper("c_name").alias("c_name"))
    return merge.merge_upsert(target, source, ["c_custkey"], update=["c_name"], constants={"active": 1})


@query("keyed_update", """
SELECT c_custkey, c_name, coalesce(top, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey""")
def _(s):
    top = s.orders.where("o_orderstatus = 'P'").groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return merge.keyed_update(s.customer.select("c_custkey", "c_name", "c_acctbal"), top, ["c_custkey"], ["c_acctbal"])


@query("derived_refresh", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def _(s):
    loaded, derived = new_target(s), new_target(s)
    loaded.full_refresh(s.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus"))
    derived.refresh_from(loaded, ["l_returnflag", "l_linestatus", "l_suppkey"])
    return derived.read()


@query("derived_counts", """
WITH loaded AS (
  SELECT o_custkey % 50 AS k, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL SELECT o_custkey % 50 + 25, o_orderpriority, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_custkey % 3 = 0)
SELECT k, status, count(*) AS n FROM loaded GROUP BY k, status""")
def _(s):
    """A window load changes the counts of the rows it takes away and brings, and the table equals the full distinct."""
    rows = s.orders.select((c("o_custkey") % 50).alias("k"), F.when(c("o_orderstatus") != "P", c("o_orderstatus")).alias("status"), "o_orderdate")
    derived = DerivedTarget(new_target(s), new_target(s), ["k", "status"])
    derived.loaded.full_refresh(rows)
    derived.rebuild()
    new = s.orders.where((c("o_orderdate") >= dates.ntz("1999-01-01")) & (c("o_custkey") % 3 == 0))
    new = new.select((c("o_custkey") % 50 + 25).alias("k"), c("o_orderpriority").alias("status"), "o_orderdate")
    derived.replace_window(new, c("o_orderdate") >= dates.ntz("1999-01-01"))
    return derived.counts().withColumnRenamed(merge.COUNT, "n")


@query("merge_upsert_indexed", """
SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
UNION ALL SELECT -1, 0, 1900""")
def _(s):
    """Few keys, found through sorted row groups and their Bloom filters."""
    target = new_target(s, partition_by=["y"], key_index="o_orderkey", row_group_bytes=64 << 10)
    rows = s.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    target.full_refresh(rows)
    changed = rows.where("o_orderkey % 997 = 5").withColumn("o_totalprice", c("o_totalprice") + 1)
    added = s.spark.range(1).select(F.lit(-1).cast("bigint").alias("o_orderkey"), F.lit(0.0).alias("o_totalprice"), F.lit(1900).alias("y"))
    target.merge(changed.unionByName(added), ["o_orderkey"], update=["o_totalprice"], insert_only=["y"])
    return target.read()


@query("sink_project_rename", "SELECT p_partkey AS part_id, p_name AS topic, p_size AS size FROM part")
def _(s):
    return merge.project_to_target(s.part, ["part_id", "topic", "size"], {"part_id": "p_partkey", "topic": "p_name", "size": "p_size"})


@query("run_audit", "SELECT 'customers' AS name, (SELECT count(*) FROM customer) AS rows, false AS failed UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), false")
def _(s):
    audit, target = RunAudit(s.spark, work_dir(s.spark)), new_target(s)
    audit.run("customers", lambda: s.customer.select("c_custkey"), target.append)
    audit.run("orders", lambda: s.orders.select(c("o_custkey").alias("c_custkey")), target.append)
    return audit.read().select("name", "rows", c("error").isNotNull().alias("failed"))


@query("option_set_decode_map", f"""
WITH dict{DICTIONARY_COLUMNS} AS (SELECT * FROM {DICTIONARY} v)
SELECT o_orderkey, a.value AS english, b.value AS polish, e.value AS other FROM orders
LEFT JOIN dict a ON a.objecttypecode = 1 AND a.attributename = 'Priority' AND a.langid = 1033 AND a.attributevalue = o_orderkey % 5
JOIN dict b ON b.objecttypecode = 1 AND b.attributename = 'Priority' AND b.langid = 1045 AND b.attributevalue = o_custkey % 5
LEFT JOIN dict e ON e.objecttypecode = 2 AND e.attributename = 'priority' AND e.langid = 1033 AND e.attributevalue = o_custkey % 7""")
def _(s):
    """Three code columns, one projection and one filter, no join."""
    dictionary = s.spark.sql(f"SELECT * FROM {DICTIONARY} AS m{DICTIONARY_COLUMNS}")
    english, polish, other = ("Priority", 1, 1033), ("priority", 1, 1045), ("PRIORITY", 2, 1033)
    words = lookup.CodeMap(dictionary, [english, polish, other])
    rows = s.orders.select("o_orderkey", (c("o_orderkey") % 5).alias("x"), (c("o_custkey") % 5).alias("y"), (c("o_custkey") % 7).alias("z"))
    rows = words.decode(words.decode(rows, {"english": ("x", english), "other": ("z", other)}), {"polish": ("y", polish)}, how="inner")
    return rows.drop("x", "y", "z")


@query("distinct_rows_wide", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_discount, CASE WHEN l_tax < 0.04 THEN l_tax END AS low_tax, CASE WHEN l_tax >= 0.04 THEN l_tax END AS high_tax FROM lineitem")
def _(s):
    tax = c("l_tax")
    return sets.distinct_wide(
        s.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey", "l_discount", F.when(tax < 0.04, tax).alias("low_tax"), F.when(tax >= 0.04, tax).alias("high_tax"))
    )


@query("incremental_load", """
WITH mark AS (SELECT max(ts) AS latest FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_id % 10 <> 0)
SELECT event_id, user_id, CASE WHEN ts >= latest - INTERVAL 3 DAY THEN value + 1 ELSE value END AS value FROM events, mark
WHERE ts >= latest - INTERVAL 3 DAY OR event_id % 10 <> 0""")
def _(s):
    """Two loads by a mark; a tenth of the events came late, and of those only the ones within the overlap are found."""
    target, keys, overlap = new_target(s), ["event_id"], timedelta(days=3)
    first = s.events.where((c("ts") < dates.ntz("2024-01-20")) & (c("event_id") % 10 != 0))
    first = first.select("event_id", "user_id", "value", "ts")
    incremental.upsert_increment(target, "events.ts", first, "ts", overlap, keys, lambda rows: rows.drop("ts"))
    changed = s.events.select("event_id", "user_id", (c("value") + 1).alias("value"), "ts")
    incremental.upsert_increment(target, "events.ts", changed, "ts", overlap, keys, lambda rows: rows.drop("ts"))
    return target.read()


@query("incremental_append", "SELECT event_id, value FROM events")
def _(s):
    """Three appends by a mark, one of them repeated without its mark, as after a stop before the commit."""
    target = new_target(s, load_ids=True)
    rows = s.events.select("event_id", "value", "ts")
    for until in ("2024-01-10", "2024-01-20"):
        incremental.append_increment(target, "events.ts", rows.where(c("ts") < dates.ntz(until)), "ts", lambda r: r.drop("ts"))
    target.append(rows.limit(100).drop("ts"), load_id=f"events.ts after {target.marks()['events.ts']}")
    incremental.append_increment(target, "events.ts", rows, "ts", lambda r: r.drop("ts"))
    return target.read()


@query("append_with_load_ids", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part")
def _(s):
    """Loads that are repeated, before and after the target is rewritten, are one copy."""
    target = new_target(s, load_ids=True)
    loads = {"c": s.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name")), "s": s.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"))}
    for name in ("c", "s", "c"):
        target.append(loads[name], load_id=name)
    target.replace_window(s.part.select(c("p_partkey").alias("id"), c("p_name").alias("name")), c("id") < 0)
    for name in ("s", "c"):
        target.append(loads[name], load_id=name)
    return target.read()


@query("incremental_lookback", """
SELECT event_id, ts, CASE WHEN ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY THEN value + 1 ELSE value END AS value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY OR ts < TIMESTAMP '2024-01-28'""")
def _(s):
    as_of = s.events.agg(F.max("ts")).scalar()
    target = s.events.where(c("ts") < dates.ntz("2024-01-28")).select("event_id", "ts", "value")
    changed = s.events.where(filters.within_days(c("ts"), as_of, 7)).select("event_id", "ts", (c("value") + 1).alias("value"))
    return merge.merge_upsert(target, changed, ["event_id"])
