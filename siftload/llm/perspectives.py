"""Chat formatting by perspective: each participant of a dialogue in turn is the assistant, the others are named users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.operators.ranking import rank_split_groups

# Fixed values of the chat format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
# Turns in one part of an example, and turn numbers in one slice of the numbering.
TURNS_PER_PART = 64
TURNS_PER_SLICE = 256


def plain(text: Column) -> Column:
    """Text in which the format's own marks can't be taken for marks: they get a blank after the bracket."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate_perspectives(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """One example per dialogue and participant, in parts of at most ``turns_per_part`` turns.

    ``turns`` has conv_id, turn, role, text. Returns conv_id, perspective, part (from 0), n_turns, text and mask: the
    [start, end) characters of the part's text that are to be learned, which are the words of the perspective's own
    turns with their closing mark. The parts of an example, joined, are the whole dialogue.

    Every role but ``system`` is a participant; system turns keep their role and are never learned. A null role is the
    participant ``unknown``; a null text is empty. Turns are ordered by number (null first), then role and text;
    repeated rows all stay. A dialogue with system turns only has no participant and gives no row, and neither does
    a null conv_id (it names no dialogue). Extra columns are not read.

    No dialogue is ever in one task: its turns are numbered slice by slice and put together part by part.
    """
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    said = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), plain(F.col("text")).alias("said"))
    slice_of = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / TURNS_PER_SLICE)
    numbered = rank_split_groups(said, ["conv_id"], slice_of, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("said")])
    people = said.where(F.col("role") != SYSTEM).groupBy("conv_id", "role").agg(F.lit(1).alias("one"))
    views = numbered.join(people.select("conv_id", F.col("role").alias("perspective")), "conv_id")
    own = F.col("role") == F.col("perspective")
    name = F.regexp_replace(plain(F.col("role")), r"\s+", "_")
    head = F.when(own, F.lit("assistant")).when(F.col("role") == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), name))
    piece = F.struct(
        F.col("rn"),
        F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"),
        F.concat(F.col("said"), F.lit(CLOSE + "\n")).alias("body"),
        own.alias("own"),
    )
    part = F.floor((F.col("rn") - 1) / turns_per_part).cast("int")
    parts = views.groupBy("conv_id", "perspective", part.alias("part")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def add(s: Column, x: Column) -> Column:
        # The line break after the closing mark is the format's, not the speaker's.
        first = s["at"] + F.length(x["head"])
        end = first + F.length(x["body"])
        span = F.array(F.struct(first.alias("start"), (end - 1).alias("end")))
        return F.struct(end.alias("at"), F.when(x["own"], F.concat(s["mask"], span)).otherwise(s["mask"]).alias("mask"))

    return parts.select(
        "conv_id", "perspective", "part",
        F.size("pieces").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"])), "").alias("text"),
        F.aggregate("pieces", start, add, lambda s: s["mask"]).alias("mask"),
    )
