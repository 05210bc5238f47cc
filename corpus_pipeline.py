"""The corpus pipeline: stages over documents, each written to Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftload.llm import decontaminate, jaccard_join, piece_viterbi, pseudonyms, toxic_segments
from siftload.llm.common import importable, table
from siftload.sources.staging import staged

# A document is toxic from this probability on.
TOXIC_FROM = 0.3
# Near duplicates share 80 % of their five-word shingles.
WORDS_PER_SHINGLE, PERCENT = 5, 80
# Words of a benchmark item in a row that make a document contaminated.
WINDOW = 10
PSEUDONYM_KEY = "check key"


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for those of ``dropped`` (doc_id, text_hash). A null id or text equals a null one."""
    marked = docs.withColumn("__hash", F.xxhash64("text"))
    named = dropped.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text"))
    return marked.join(named, same, "left_anti").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic documents. Null and empty texts are not toxic."""
    importable(spark)
    model = toxic_segments.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxic_segments.score_toxicity(docs, model)
    return scored.where(F.col("toxicity") < TOXIC_FROM).select(*docs.columns)


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest doc_id, then text hash.

    Documents without words are linked with nothing and stay. Of rows that repeat an id and its text one stays.
    """
    importable(spark)
    rows = jaccard_join.jaccard_components(docs, WORDS_PER_SHINGLE, PERCENT).where("n_shingles > 0")
    texts = staged(rows.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = texts.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    decided = staged(texts.join(kept, "component").select("doc_id", "text_hash", "rows", is_first.alias("kept")))
    repeated = decided.where("kept AND rows > 1")
    if repeated.isEmpty():
        return without(docs, decided.where("NOT kept"))
    marked = docs.withColumn("__hash", F.xxhash64("text"))
    named = repeated.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text"))
    # Repeats are thinned before they meet: one row per task first, then one in all.
    one = marked.join(named, same, "left_semi")
    leading = Window.partitionBy("doc_id", "__hash").orderBy("__hash")
    one = one.withColumn("__rank", F.row_number().over(leading)).where("__rank = 1")
    return without(docs, decided.where("NOT kept OR rows > 1")).unionByName(one.select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no window of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), WINDOW)
    return without(docs, found.where("contaminated").select("doc_id", "text_hash").distinct())


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the place of personal data; n_chars follows the text."""
    changed = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts: doc_id, lang, source, ids, n_pieces and round_trip (the ids decode to the text)."""
    importable(spark)
    encoded = piece_viterbi.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", "ids", "n_pieces", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", jaccard_groups),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", pieces),
]

# The learned toxicity model and the piece search can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it wrote to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES):
            docs = staged(docs)
    return docs
