"""Benchmark decontamination by a prefix-filtered containment join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftload.llm.common import NOT_WORD, ascii_lower
from siftload.sources.staging import staged

# Windows are broadcast only below this many bytes, as measured; beyond it both sides are shuffled by the anchor word.
MOST_BROADCAST_BYTES = 64 << 20


def split_words(text: Column) -> Column:
    """The text's words; an empty word can stand at either end and matches nothing."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)


def count_words(words: Column) -> Column:
    n = F.size(words)
    leading = (F.element_at(words, 1) == "").cast("int")
    trailing = ((n > 1) & (F.element_at(words, -1) == "")).cast("int")
    return (n - leading - trailing).cast("long")


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """item_id, start and words of every window: ``width`` consecutive words, or the whole of a shorter item."""
    words = F.filter(split_words(F.col("text")), lambda w: w != "")
    with_words = items.select("item_id", words.alias("item")).where(F.size("item") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("item") - width, F.lit(0)))
    return with_words.select("item_id", "item", F.explode(starts).alias("start")).select(
        "item_id", "start", F.slice("item", F.col("start") + 1, F.lit(width)).alias("window")
    )


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of ``vocabulary`` (word) occurs in all documents."""
    spoken = docs.select(F.explode(split_words(F.col("text"))).alias("word"))
    return spoken.join(vocabulary, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct window with its prefix: its rarest word in the documents, and where that word stands in it.

    Containment asks for every word of a window, so the prefix that must meet is one word long. A window with a word
    that no document has can't occur and goes. Equal windows of several items are joined once, with all their items.
    """
    texts = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    each = texts.select("window", "items", F.posexplode("window").alias("offset", "word")).join(counts, "word", "left")
    order = Window.partitionBy("window").orderBy(F.col("n").asc_nulls_first(), "word", "offset")
    rarest = each.withColumn("rank", F.row_number().over(order)).where("rank = 1 AND n IS NOT NULL")
    return rarest.select(F.col("word").alias("anchor"), "offset", "window", F.size("window").alias("length"), "items")


def find_hits(docs: DataFrame, anchors: DataFrame, small: bool) -> DataFrame:
    """One row per document and occurring window (items, start, length), and one row per document with items null.

    The document's words are put in rows once; those that are no anchor end in the join. Only where an anchor stands
    inside its length and position bounds are the window's words compared.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), split_words(F.col("text")).alias("words"))
    split = split.select("doc_id", "text_hash", count_words(F.col("words")).alias("n_words"), "words")
    start = F.col("at") - F.col("offset")
    out = ["doc_id", "text_hash", "n_words", "items", start.alias("start"), "length"]
    if small:
        # No word holds a line break: as a last word it brings the document's own row through the same join.
        spoken = split.select("*", F.posexplode(F.concat("words", F.array(F.lit("\n")))).alias("at", "word"))
        own = anchors.sparkSession.createDataFrame([("\n", 0, None, None, None)], anchors.schema)
        met = spoken.join(F.broadcast(anchors.unionByName(own)), F.col("word") == F.col("anchor"))
        fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
        same = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window")
        return met.where(F.col("items").isNull() | (fits & same)).select(*out)
    # Words that are shuffled carry their surroundings, never the whole document.
    reach = anchors.agg(F.max("length")).first()[0]
    first = F.greatest(F.col("at") - F.lit(reach - 1), F.lit(0))
    spoken = split.select("*", F.posexplode("words").alias("at", "word"))
    near = F.slice("words", first + 1, F.lit(2 * reach - 1)).alias("near")
    around = spoken.select("doc_id", "text_hash", "n_words", "at", "word", first.alias("near_at"), near)
    inside = start - F.col("near_at")
    met = around.join(anchors, F.col("word") == F.col("anchor"))
    fits = (inside >= 0) & (inside + F.col("length") <= F.size("near"))
    same = F.slice("near", F.greatest(inside, F.lit(0)) + 1, F.col("length")) == F.col("window")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("items", anchors.schema["items"].dataType), ("start", "int"), ("length", "int"))]
    return met.where(fits & same).select(*out).unionByName(split.select("doc_id", "text_hash", "n_words", *none))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """What of each document stands in a benchmark item: one row per document row.

    Returns doc_id, text_hash (xxhash64), n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256 (of the item ids,
    sorted as text, comma-joined; of empty text when there is none), contaminated. Null and empty texts have no words;
    repeated rows come back repeated; rows with equal ids and different texts stay apart. A null item_id is not listed
    but its words are hit. Without items nothing is contaminated. Extra columns are not read.
    """
    windows = staged(item_windows(items, width))
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    anchors = staged(anchored(windows, word_counts(docs, vocabulary)))
    size = anchors.agg(F.sum(F.length(F.array_join("window", " ")) * 2 + 64 + 16 * F.size("items"))).first()[0] or 0
    hits = find_hits(docs, anchors, size <= MOST_BROADCAST_BYTES)
    spans = F.collect_set(F.when(F.col("items").isNotNull(), F.struct("start", "length")))
    found = hits.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count_if(F.col("items").isNull()).alias("rows"),
        spans.alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "text_hash", "n_words",
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row"),
    ).drop("row")
