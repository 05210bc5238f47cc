"""Scalar operators, one projection each."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import query
from siftload.functions import codes, dates, numbers, text
from siftload.operators import filters

c = F.col



def split_example():
    return text.split_code(F.concat_ws("|", c("c_mktsegment"), c("c_nationkey"), F.when(c("c_nationkey") > 9, c("c_name"))))


# key: (table, key columns, {output: (Spark column, SQL)})
SCALARS = {
    "str_replace": ("part", ["p_partkey"], {
        "out": (lambda: text.str_replace(c("p_name"), "e", "--"), "replace(p_name, 'e', '--')")}),
    "strip_control_chars": ("pages", ["page_id"], {
        "out": (lambda: text.strip_control_chars(c("html")), "translate(html, chr(10) || chr(12) || chr(13) || ';^', '')"),
        "lines": (lambda: text.strip_control_chars(c("html"), text.LINE_BREAKS), "replace(replace(html, chr(10), ''), chr(13), '')")}),
    "substring_fixed": ("part", ["p_partkey"], {
        "inside": (lambda: text.substring_fixed(c("p_type"), 2, 3), "substr(p_type, 2, 3)"),
        "from_zero": (lambda: text.substring_fixed(c("p_name"), 0, 6), "substr(p_name, 1, 5)")}),
    "strip_domain_prefix": ("customer", ["c_custkey"], {
        "login": (lambda: text.strip_domain_prefix(c("c_name"), 10), "substr(c_name, 4, 10)"),
        "lowered": (lambda: text.strip_domain_prefix(c("c_name"), 20, lower=True), "lower(substr(c_name, 4, 20))"),
        "cut": (lambda: text.login_without_domain(F.concat(F.lit("TP\\"), c("c_name"))), "lower(c_name)")}),
    "normalise_customer_id": ("customer", ["c_custkey"], {
        "short_form": (lambda: text.normalise_customer_id(F.concat(F.lit("R"), c("c_custkey"), F.lit("R"), F.lpad(c("c_nationkey").cast("string"), 3, "0"))),
                       "'R' || c_custkey || 'R' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')"),
        "long_form": (lambda: text.normalise_customer_id(F.concat(F.lit("R"), c("c_custkey"), F.lit("R"), (c("c_custkey") + 10000).cast("string"))),
                      "CAST(c_custkey AS VARCHAR)"),
        "plain": (lambda: text.normalise_customer_id(c("c_custkey").cast("string")), "CAST(c_custkey AS VARCHAR)"),
        "chosen": (lambda: text.normalise_customer_id(c("c_name"), F.when(c("c_nationkey") > 12, c("c_mktsegment"))),
                   "CASE WHEN c_nationkey > 12 THEN c_mktsegment ELSE c_name END")}),
    "prefix_before_dash": ("orders", ["o_orderkey"], {
        "tight": (lambda: text.prefix_before_dash(c("o_orderpriority")), "''"),
        "spaced": (lambda: text.prefix_before_dash(F.concat(c("o_orderstatus"), F.lit("x - "), c("o_orderpriority"))), "o_orderstatus || 'x'"),
        "none": (lambda: text.prefix_before_dash(c("o_orderstatus")), "''")}),
    "suffix_after_underscore": ("nation", ["n_nationkey"], {
        "suffix": (lambda: text.suffix_after_underscore(c("n_name")), "split_part(n_name, '_', 2)"),
        "last": (lambda: text.suffix_after_underscore(F.concat(F.lit("a_b_"), c("n_name"))), "list_last(string_split('a_b_' || n_name, '_'))"),
        "none": (lambda: text.suffix_after_underscore(F.replace(c("n_name"), F.lit("_"), F.lit("-"))), "''")}),
    "trim_both": ("part", ["p_partkey"], {
        "out": (lambda: text.trim_both(F.concat(F.lit("  "), c("p_name"), F.lit(" "))), "p_name")}),
    "case_fold": ("customer", ["c_custkey"], {
        "upper_name": (lambda: F.upper(c("c_name")), "upper(c_name)"), "lower_segment": (lambda: F.lower(c("c_mktsegment")), "lower(c_mktsegment)")}),
    "find_position": ("part", ["p_partkey"], {
        "first": (lambda: text.find_position(c("p_name"), "e").cast("bigint"), "CAST(instr(p_name, 'e') AS BIGINT)"),
        "later": (lambda: text.find_position(c("p_name"), "e", 4).cast("bigint"),
                  "CAST(CASE WHEN instr(substr(p_name, 4), 'e') = 0 THEN 0 ELSE instr(substr(p_name, 4), 'e') + 3 END AS BIGINT)")}),
    "clean_money_text": ("orders", ["o_orderkey"], {
        "money": (lambda: text.clean_money_text(F.concat(F.lit(" "), F.translate(c("o_totalprice").cast("decimal(14,2)").cast("string"), ".", ","), F.lit(" zł"))),
                  "CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS DOUBLE)"),
        "quoted": (lambda: text.clean_money_text(F.concat(F.lit("'"), c("o_custkey").cast("string"), F.lit(" 000"))),
                   "CAST(CAST(o_custkey AS VARCHAR) || '000' AS DOUBLE)"),
        "letters": (lambda: text.clean_money_text(F.concat(c("o_custkey").cast("string"), F.lit("e2"))), "CAST(0 AS DOUBLE)"),
        "broken": (lambda: text.clean_money_text(F.concat(c("o_custkey").cast("string"), F.lit("--1"))), "CAST(0 AS DOUBLE)")}),
    "split_code": ("customer", ["c_custkey"], {
        "w1": (lambda: split_example()[0], "c_mktsegment"),
        "w2": (lambda: split_example()[1], "CAST(c_nationkey AS VARCHAR)"),
        "w3": (lambda: split_example()[2], "CASE WHEN c_nationkey > 9 THEN c_name END"),
        "w4": (lambda: split_example()[3], "CAST(NULL AS VARCHAR)")}),
    "truncate_text": ("conversations", ["conv_id", "turn"], {
        "out": (lambda: text.truncate_text(F.concat(c("role"), F.lit("&'"), c("text"))),
                "substr(replace(replace(role || '&''' || text, '&', ' AND '), '''', ''), 1, 450)")}),
    "replace_whole_value": ("part", ["p_partkey"], {
        "whole": (lambda: text.replace_whole_value(c("p_type"), "SMALL", "S"), "CASE WHEN p_type = 'SMALL' THEN 'S' ELSE p_type END"),
        "part_only": (lambda: text.replace_whole_value(c("p_name"), "e", ""), "p_name")}),
    "remap_values": ("orders", ["o_orderkey"], {
        "out": (lambda: text.remap_values(c("o_orderstatus"), {"O": "open", "F": "filled"}),
                "CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END")}),
    "contains_letters": ("events", ["event_id"], {
        "in_props": (lambda: text.contains_letters(c("props")), "regexp_matches(props, '[A-Za-z]')"),
        "in_user": (lambda: text.contains_letters(c("user_id").cast("string")), "false")}),
    "like_label": ("part", ["p_partkey"], {
        "out": (lambda: text.like_label(c("p_name"), {"%ring": "ring", "%blue%": "blue", "small%": "small"}),
                "CASE WHEN p_name LIKE '%ring' THEN 'ring' WHEN p_name LIKE '%blue%' THEN 'blue' WHEN p_name LIKE 'small%' THEN 'small' ELSE '' END")}),
    "concat_text": ("part", ["p_partkey"], {
        "out": (lambda: text.concat_text(c("p_brand"), "/", c("p_type")), "p_brand || '/' || p_type"),
        "with_null": (lambda: text.concat_text(c("p_brand"), F.when(c("p_size") > 25, c("p_type"))), "p_brand || CASE WHEN p_size > 25 THEN p_type END")}),
    "date_to_text": ("events", ["event_id"], {
        "day": (lambda: dates.date_to_text(c("ts")), "strftime(ts, '%Y-%m-%d')"),
        "minute": (lambda: dates.date_to_text(c("ts"), dates.MINUTE_FORMAT), "strftime(ts, '%Y-%m-%d %H:%M')"),
        "second": (lambda: dates.date_to_text(c("ts"), dates.SECOND_FORMAT), "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
        "short_year_pattern": (lambda: dates.date_to_text(c("ts"), "yyy-MM-dd"), "strftime(ts, '%Y-%m-%d')")}),
    "shift_hours_fixed": ("events", ["event_id"], {"out": (lambda: dates.shift_hours_fixed(c("ts")), "ts + INTERVAL 2 HOUR")}),
    "shift_hours_by_period": ("events", ["event_id"], {
        "shifted": (lambda: dates.shift_hours_by_period(c("ts"), [("2024-01-05", "2024-01-11", 1), ("2024-01-11", "2024-01-20 12:00:00", 3)]),
                    "CASE WHEN ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-11' THEN ts + INTERVAL 1 HOUR "
                    "WHEN ts BETWEEN TIMESTAMP '2024-01-11' AND TIMESTAMP '2024-01-20 12:00:00' THEN ts + INTERVAL 3 HOUR ELSE ts + INTERVAL 2 HOUR END"),
        "zone": (lambda: dates.shift_to_zone(c("ts")), "ts + INTERVAL 1 HOUR")}),
    "add_days": ("orders", ["o_orderkey"], {"out": (lambda: dates.add_days(c("o_orderdate")), "o_orderdate + INTERVAL 1 DAY")}),
    "to_date": ("events", ["event_id"], {"out": (lambda: dates.to_day(c("ts")), "CAST(ts AS DATE)")}),
    "year_of": ("orders", ["o_orderkey"], {"out": (lambda: dates.year_of(c("o_orderdate")).cast("bigint"), "CAST(year(o_orderdate) AS BIGINT)")}),
    "days_before_now": ("events", ["event_id"], {
        "recent": (lambda: c("ts") >= dates.days_before("2024-01-31", 10), "ts >= TIMESTAMP '2024-01-21'")}),
    "parse_timestamp": ("events", ["event_id"], {
        "fits": (lambda: dates.parse_timestamp(F.date_format(c("ts"), "yyyy-MM-dd HH:mm:ss")), "date_trunc('second', ts)"),
        "broken": (lambda: dates.parse_timestamp(c("event_type")), "CAST(NULL AS TIMESTAMP)")}),
    "cast_numeric": ("orders", ["o_orderkey"], {
        "whole": (lambda: c("o_totalprice").cast("bigint"), "CAST(trunc(o_totalprice) AS BIGINT)"),
        "money": (lambda: numbers.cast_numeric(c("o_totalprice"), "decimal(12,2)"), "CAST(o_totalprice AS DECIMAL(12, 2))"),
        "from_text": (lambda: numbers.cast_numeric(F.substring(c("o_orderpriority"), 1, 1), "double"), "TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)"),
        "no_number": (lambda: numbers.cast_numeric(c("o_orderstatus"), "double"), "CAST(NULL AS DOUBLE)")}),
    "to_number_or_zero": ("events", ["event_id"], {
        "from_props": (lambda: numbers.to_number_or_zero(c("props")), "coalesce(TRY_CAST(props AS DOUBLE), 0)"),
        "from_value": (lambda: numbers.to_number_or_zero(c("value").cast("string")), "value"),
        "cut": (lambda: numbers.to_number_or_zero(c("value").cast("string"), "bigint"), "CAST(trunc(value) AS BIGINT)")}),
    "round_or_zero": ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], {
        "amount": (lambda: numbers.round_or_zero(c("l_extendedprice").cast("string"), 0), "round(l_extendedprice, 0)"),
        "missing": (lambda: numbers.round_or_zero(F.when(c("l_returnflag") == "R", F.lit("#N/A")).otherwise(F.lit(""))), "CAST(0 AS DOUBLE)")}),
    "unit_scale": ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], {
        "out": (lambda: numbers.unit_scale(c("l_quantity")), "l_quantity * 1000")}),
    "margin_formula": ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], {
        "out": (lambda: F.round(numbers.margin_formula(
            F.when(c("l_returnflag") == "R", c("l_tax")), c("l_linestatus") == "F", c("l_discount"), c("l_extendedprice"), c("l_tax"), c("l_quantity")), 6),
            "round(CASE WHEN l_returnflag = 'R' AND l_tax <> 0 THEN l_tax WHEN l_linestatus = 'F' THEN l_discount * l_extendedprice / 100 "
            "ELSE l_tax * l_quantity / 100 END, 6)")}),
    "uniform_duration": ("part", ["p_partkey"], {
        "months": (lambda: numbers.uniform_duration(F.when(c("p_size") < 10, F.lit(100)).when(c("p_size") < 40, c("p_size")), c("p_size") + 500),
                   "CASE WHEN p_size < 10 THEN p_size + 500 WHEN p_size < 40 THEN p_size ELSE 0 END"),
        "any_code": (lambda: numbers.duration_or_free_field(F.when(c("p_size") < 10, F.lit(100)).otherwise(c("p_size") + 90), c("p_size"), "bigint"),
                     "CAST(CASE WHEN p_size < 10 OR p_size = 10 THEN p_size ELSE p_size + 90 END AS BIGINT)")}),
    "guid_to_text": ("orders", ["o_orderkey"], {
        "out": (lambda: text.guid_to_text(F.rpad(c("o_orderkey").cast("string"), 40, " ")), "CAST(o_orderkey AS VARCHAR)")}),
    "literal_column": ("part", ["p_partkey"], {
        "topic_type": (lambda: F.lit(""), "''"), "label": (lambda: F.lit("fixed label"), "'fixed label'")}),
    "project_alias": ("orders", ["o_orderkey"], {
        "order_number": (lambda: c("o_orderkey"), "o_orderkey"), "status": (lambda: c("o_orderstatus"), "o_orderstatus"), "amount": (lambda: c("o_totalprice"), "o_totalprice")}),
    "case_searched": ("part", ["p_partkey"], {
        "band": (lambda: codes.classify([(c("p_retailprice") < 950, "low"), (c("p_retailprice") < 1000, "middle")], "high"),
                 "CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1000 THEN 'middle' ELSE 'high' END")}),
    "decode_ladder": ("orders", ["o_orderkey"], {
        "stage": (lambda: codes.decode_ladder(F.substring(c("o_orderpriority"), 1, 1).cast("int"), {0: "Suspecting", 1: "Prospecting", 2: "Analyzing", 3: "Negotiating"}),
                  "CASE substr(o_orderpriority, 1, 1) WHEN '0' THEN 'Suspecting' WHEN '1' THEN 'Prospecting' WHEN '2' THEN 'Analyzing' WHEN '3' THEN 'Negotiating' END")}),
    "sentinel_to_null": ("part", ["p_partkey"], {
        "out": (lambda: text.blank_if_null(text.sentinel_to_null(c("p_type"), "ECONOMY")), "CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END")}),
    "row_expressions": ("events", ["event_id"], {
        "rounded": (lambda: numbers.round_or_zero(F.when(c("event_type") == "error", F.lit("#N/A")).otherwise(c("value").cast("string")), 1),
                    "CASE WHEN event_type = 'error' THEN 0 ELSE round(CAST(value AS DECIMAL(18, 4)), 1)::DOUBLE END"),
        "shortened": (lambda: text.truncate_text(F.concat(c("event_type"), F.lit(" & 'x'")), 9), "substr(event_type || '  AND  x', 1, 9)")}),
    "filter_compare_flags": ("orders", ["o_orderkey"], {
        "text_number": (lambda: filters.equals_text_number(c("o_custkey"), "2", "bigint"), "o_custkey = 2"),
        "listed": (lambda: filters.listed_or(c("o_totalprice") > 400000, c("o_orderkey"), [1, 5, 9]), "o_totalprice > 400000 OR o_orderkey IN (1, 5, 9)")}),
}


def _register(key, table, keys, outs):
    select = ", ".join([*keys, *[f"{sql} AS {name}" for name, (_, sql) in outs.items()]])

    @query(key, f"SELECT {select} FROM {table}")
    def _(star):
        return getattr(star, table).select(*keys, *[column().alias(name) for name, (column, _) in outs.items()])


for _key, (_table, _keys, _outs) in SCALARS.items():
    _register(_key, _table, _keys, _outs)
