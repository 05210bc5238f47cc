"""Expressions and batch helpers the operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (loads pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of runs of letters, digits and all characters beyond ASCII, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it, whatever folder they start in."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Text without other characters takes the byte-wise ``lower``."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def utf8_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slices_of(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows with about ``most_bytes`` of text each, one row at least."""
    sizes = [0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()]
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most_bytes:
            yield start, i - start
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes) - start


def text_runs(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of bounded text, so that what a task builds beside them is bounded, too."""
    for batch in batches:
        for start, length in slices_of(batch.column(column), most_bytes):
            yield batch.slice(start, length)
