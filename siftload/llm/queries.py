"""The registered queries of this subpackage, with SQL for DuckDB where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftload.llm import (
    decontaminate,
    jaccard_join,
    jump_shards,
    license_scan,
    line_dedup,
    merkle_manifest,
    periodic_runs,
    perspectives,
    piece_viterbi,
    pseudonyms,
    quality_trees,
    token_shards,
    toxic_segments,
)
from siftload.llm.common import table

# A real collection passes a secret of its own here.
PSEUDONYM_KEY = "check key"


def op1_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return token_shards.token_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op2_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return jump_shards.shard_documents(table(spark, folder, "documents"), shards=24)


def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"), words_per_shingle=4, percent=85).drop("text_hash", "component")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)
    return found.drop("text_hash")


def op6_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_trees.rate_quality(docs, quality_trees.fit_quality(docs, table(spark, folder, "labels")))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents")).drop("found")


def op8_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return perspectives.rotate_perspectives(table(spark, folder, "conversations"))


def op9_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxic_segments.fit_toxicity(docs, table(spark, folder, "labels"))
    return toxic_segments.score_toxicity(docs, model).select(
        "doc_id",
        toxic_segments.held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"),
        F.size("toxic_segments").alias("n_segments"),
    )


def op10_piece_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_viterbi.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, folder, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    planted = docs.select("doc_id", periodic_runs.with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    best = periodic_runs.longest_run(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periodic_runs.find_runs(planted).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.verify_documents(table(spark, folder, "documents"))


_ALL = (
    op1_token_shards, op2_jump_shards, op3_pseudonyms, op4_jaccard_join, op5_decontaminate, op6_quality_trees,
    op7_license_scan, op8_perspectives, op9_toxic_segments, op10_piece_viterbi, op11_line_dedup, op12_periodic_runs,
    op13_merkle_manifest,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# A leaf's values as the contract has them: a byte count, a colon and the value, or a dash.
_LEAF_TEXT = "coalesce(octet_length(encode({text})) || ':' || {text}, '-')"
_LEAF_FIELDS = " || ".join(_LEAF_TEXT.format(text=f"({c}::VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars"))

# Words as the contract has them, and the windows of the items.
_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "op5_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[s : s + 9] AS g, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, s, n, w[s : s + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT doc_id, item_id, s, n FROM grams JOIN windows USING (g, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    # Documents are told apart by a row number, as ids may repeat.
    "op11_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT n, doc_id, p, lines[p] AS line FROM (SELECT n, doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM d)),
k AS (
  SELECT n, doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10),
m AS (SELECT k.*, often.key IS NOT NULL AS dropped FROM k LEFT JOIN often ON k.key = often.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY n, doc_id
""",
    # crc32 by its table, which follows from the polynomial. Trees of sources (t = 0) and of their tops (t = 1).
    "op13_merkle_manifest": f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)
),
d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS grp,
         {_LEAF_FIELDS} || {_LEAF_TEXT.format(text="text")} AS plain,
         {_LEAF_FIELDS} || {_LEAF_TEXT.format(text=_LOWER.format(text="text"))} AS lower_case,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc_table
),
h AS (SELECT id, doc_id, grp, sha256(plain) AS digest, CASE WHEN crc % 5 = 0 THEN sha256(lower_case) ELSE sha256(plain) END AS start FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM h),
tree AS (
  SELECT grp, 0 AS lvl, idx, n, digest FROM leaves
  UNION ALL
  SELECT grp, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY grp, lvl, idx // 16, n
),
subroots AS (SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 16, n
),
nodes AS (SELECT 0 AS t, * FROM tree WHERE n > 1 UNION ALL SELECT 1, '', * FROM top WHERE n > 1),
places AS (SELECT id, 0 AS t, grp, idx FROM leaves UNION ALL SELECT id, 1, '', s.idx FROM leaves JOIN subroots s USING (grp)),
steps AS (
  SELECT id, t, lvl, coalesce(string_agg(digest, '' ORDER BY nodes.idx) FILTER (WHERE nodes.idx < places.idx >> (4 * lvl)), '') AS b,
         coalesce(string_agg(digest, '' ORDER BY nodes.idx) FILTER (WHERE nodes.idx > places.idx >> (4 * lvl)), '') AS a
  FROM places JOIN nodes USING (t, grp) WHERE nodes.idx >> 4 = places.idx >> (4 * (lvl + 1)) GROUP BY id, t, lvl
),
ways AS (SELECT id, list({{'b': b, 'd': '', 'a': a}} ORDER BY t, lvl) AS way, string_agg(b || a, '' ORDER BY t, lvl) AS siblings FROM steps GROUP BY id),
proved AS (
  SELECT doc_id, leaves.digest AS leaf, subroots.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_concat([{{'b': '', 'd': start, 'a': ''}}], coalesce(way, [])), lambda x, s: {{'b': '', 'd': sha256(s.b || x.d || s.a), 'a': ''}}).d AS folded_root
  FROM leaves JOIN subroots USING (grp) LEFT JOIN ways USING (id)
)
SELECT *, folded_root = root AS verified FROM proved
""",
}
