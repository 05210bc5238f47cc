"""A Merkle manifest of a dataset: digests of rows, folded 16 by 16 into one root per group and one root of all groups.

Every inner node is a record, digest to children, in a store addressed by content. A proof is a descent: the way from the
root to a leaf is spelt by the digits of the leaf's rank in base 16; at each record the digit picks the child to go on with
and the other children are collected as that level's siblings. The segments come down from the root and are reversed, so
that folding goes from the leaf up. Leaves below one lowest node share all but their last segment, so a path is carried per
node and not per leaf.

Ranks come from ranges of (group, order), so no group has to fit in a task: rows are sorted within their range, numbered
there, and a range's start within its group is added from the counts per range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftload.llm.common import ascii_lower, importable
from siftload.sources.staging import staged

# Sixteen children a node: a digit of a rank is four bits.
DIGIT_BITS = 4
FAN_OUT = 1 << DIGIT_BITS
SEGMENT = "struct<before:string,after:string>"
# Spark's increasing ids hold the row within its range in these bits and the range above them.
ROW_BITS = 33


def sha256(*texts: Column) -> Column:
    """Lowercase hex digest of texts laid end to end."""
    return F.sha2(F.concat(*texts), 256)


def field(c: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself, or ``-`` for null; so no two rows read the same."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return sha256(*[field(c) for c in fields])


def group_key(c: Column) -> Column:
    """Text that is never null and sorts as ``c`` does, null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


# ---------------------------------------------------------------- trees


@dataclass
class Forest:
    """One tree per group. ``leaves``: grp, n (leaves of the group), rank, digest and what else came with them; ``levels``:
    grp, n, rank, digest and children of the nodes above, lowest level first; ``tops``: grp, n, height and digest of each tree."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, ord, digest, ...) with rank, from 0 within grp by ord (null first), then digest, and n, the rows of grp.

    Rows alike in all three are told apart by a random number for their range only, so that very many of them don't fall
    in one range; which of them gets which rank makes no difference.
    """
    held = staged(leaves)
    dealt = held.withColumn("__deal", F.rand(7)).repartitionByRange("grp", F.col("ord").asc_nulls_first(), "digest", "__deal")
    sorted_rows = dealt.sortWithinPartitions("grp", F.col("ord").asc_nulls_first(), "digest")
    at = F.monotonically_increasing_id()
    in_range = at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = staged(sorted_rows.select(*leaves.columns, F.shiftright(at, ROW_BITS).alias("__range"), in_range.alias("__at")))
    counts = staged(numbered.groupBy("grp", "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")))
    group = Window.partitionBy("grp")
    before = F.sum("__n").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("grp", "__range", F.sum("__n").over(group).alias("n"), (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    joined = numbered.join(staged(starts), ["grp", "__range"])
    return joined.withColumn("rank", F.col("__at") + F.col("__shift")).drop("__range", "__at", "__shift")


def grow(leaves: DataFrame) -> Forest:
    """Trees over ``leaves`` (grp, ord, digest, ...)."""
    rows = staged(ranked(leaves))
    most = rows.agg(F.max("n")).first()[0] or 0
    nodes, levels = rows.select("grp", "n", "rank", "digest"), []
    tops = nodes.where("n = 1").select("grp", "n", F.lit(0).alias("height"), "digest")
    while FAN_OUT ** len(levels) < most:
        # A tree of few leaves was done further down.
        going = nodes.where(F.col("n") > FAN_OUT ** len(levels))
        held = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        parents = going.groupBy("grp", "n", F.shiftright("rank", DIGIT_BITS).alias("rank")).agg(F.transform(held, lambda x: x["digest"]).alias("children"))
        levels.append(staged(parents.select("grp", "n", "rank", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children")))
        nodes = levels[-1].select("grp", "n", "rank", "digest")
        done = nodes.where(F.col("n") <= FAN_OUT ** len(levels))
        tops = tops.unionByName(done.select("grp", "n", F.lit(len(levels)).alias("height"), "digest"))
    return Forest(rows, levels, staged(tops))


# ---------------------------------------------------------------- manifest and proofs


@dataclass
class Manifest:
    """``groups`` are the trees of rows, ``top`` the one tree of their subroots (its group is the empty text)."""

    groups: Forest
    top: Forest

    def root(self) -> str | None:
        """The digest of the whole dataset; None without rows."""
        row = self.top.tops.first()
        return row["digest"] if row else None

    def records(self) -> DataFrame:
        """The store: digest and children of every inner node, once each."""
        levels = [level.select("digest", "children") for level in (*self.groups.levels, *self.top.levels)]
        if not levels:
            return self.top.tops.select("digest", F.array().cast("array<string>").alias("children")).limit(0)
        store = levels[0]
        for more in levels[1:]:
            store = store.unionByName(more)
        return store.dropDuplicates(["digest"])

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """The leaves with subroot, root and path: what stands before and after the leaf's own node at each level, from the
        leaf up. ``requests`` (grp, rank) asks for some; by default all leaves are asked for."""
        leaves = self.groups.leaves
        if requests is not None:
            leaves = leaves.join(requests.select("grp", "rank").distinct(), ["grp", "rank"], "left_semi")
        start = self.top.tops.select("grp", F.lit(0).cast("long").alias("rank"), "digest", "height", F.array().cast(f"array<{SEGMENT}>").alias("path"), F.col("digest").alias("root"))
        # The leaves of the top tree are the subroots: their order is the group.
        subroots = _descend(start, self.top.levels, 0).select("rank", "path", "root")
        tops = self.top.leaves.select("rank", F.col("ord").alias("grp"), F.col("digest").alias("subroot"))
        begun = tops.join(subroots, "rank").drop("rank").join(self.groups.tops.select("grp", "height"), "grp")
        begun = staged(begun.select("grp", F.lit(0).cast("long").alias("rank"), F.col("subroot").alias("digest"), "height", "path", "root", "subroot"))
        lowest = _descend(begun, self.groups.levels, 1, None if requests is None else leaves)
        lone = lowest.where("height = 0").withColumn("children", F.lit(None).cast("array<string>"))
        if self.groups.levels:
            lone = lone.unionByName(_with_children(lowest.where("height > 0"), self.groups.levels[0]))
        asked = leaves.withColumn("block", F.shiftright("rank", DIGIT_BITS))
        found = asked.join(lone.withColumnRenamed("rank", "block").drop("digest", "height"), ["grp", "block"])
        own = _segment(F.col("children"), F.col("rank").bitwiseAND(F.lit(FAN_OUT - 1).cast("long")).cast("int"))
        up = F.reverse("path")
        return found.withColumn("path", F.when(F.col("children").isNull(), up).otherwise(F.concat(F.array(own), up))).drop("children", "block")


def _segment(children: Column, digit: Column) -> Column:
    """The children a digit doesn't pick: those before it and those after it, each end to end."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.lit(FAN_OUT)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def _with_children(frontier: DataFrame, level: DataFrame) -> DataFrame:
    """The records of the frontier's digests. Nodes alike in content are one record."""
    return frontier.join(level.select("digest", "children").dropDuplicates(["digest"]), "digest")


def _descend(start: DataFrame, levels: list[DataFrame], down_to: int, wanted: DataFrame | None = None) -> DataFrame:
    """Goes down from the trees' tops (``start``: grp, rank, digest, height, path) to the nodes of level ``down_to``.

    Each level's records are looked up by digest; every digit gives one child, with what it leaves aside as one more segment
    of its path. Of ``wanted`` leaves only ways that lead to one are followed. Trees lower than ``down_to`` stay at their tops.
    """
    done = start.where(F.col("height") <= down_to)
    frontier = None
    for h in range(len(levels), down_to, -1):
        here = start.where(F.col("height") == h)
        if frontier is not None:
            here = here.unionByName(frontier)
        found = _with_children(here, levels[h - 1])
        others = [c for c in start.columns if c not in ("rank", "digest", "path")]
        each = found.select(*others, "rank", "path", "children", F.posexplode("children").alias("digit", "digest"))
        down = (F.shiftleft("rank", DIGIT_BITS) + F.col("digit")).alias("rank")
        path = F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path")
        frontier = each.select(*others, down, "digest", path).select(*start.columns)
        if wanted is not None:
            places = wanted.select("grp", F.shiftright("rank", DIGIT_BITS * (h - 1)).alias("rank")).distinct()
            frontier = frontier.join(places, ["grp", "rank"], "left_semi").select(*start.columns)
        frontier = staged(frontier)
    return done if frontier is None else done.unionByName(frontier)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, s: sha256(s["before"], digest, s["after"]))


def build_manifest(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves``: grp (text, never null; see ``group_key``), ord and digest; other columns come along.

    Within a group leaves go by ord, null first, then by digest; rows alike in both are leaves of their own next to each
    other. Groups go by the bytes of grp. A lone leaf is its group's subroot and a lone subroot the root. Without rows there
    is no root.
    """
    importable(leaves.sparkSession)
    groups = grow(leaves)
    return Manifest(groups, grow(groups.tops.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "digest")))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of ``docs``: doc_id, source, lang, n_chars and text in one digest, grouped by source, in order of doc_id.

    Nulls are ``-``; a null source is a group of its own, the first. Repeated rows are leaves of their own. ``tampered`` is
    the digest with the text's A-Z in lower case, for documents whose decimal id's crc32 is divisible by 5, else null; a
    null id has none. Other columns are not read.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        group_key(F.col("source")).alias("grp"),
        F.col("doc_id").alias("ord"),
        leaf_digest([*fields, F.col("text")]).alias("digest"),
        F.when(picked, leaf_digest([*fields, ascii_lower(F.col("text"))])).alias("tampered"),
    )


def verify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root and proof_sha256 of every row; folded_root from the tampered digest, where there is one,
    and verified: whether that is the root."""
    proofs = build_manifest(document_leaves(docs)).proofs()
    root = folded(F.coalesce("tampered", "digest"), F.col("path"))
    return proofs.select(
        F.col("ord").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
