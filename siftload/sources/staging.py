"""Intermediate tables in the shared work folder. They cut lineage and outlive lost executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from siftload.session import work_dir


def staged(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes ``df`` once and reads it back; the row count of the result comes from the file footers."""
    folder = work_dir(df.sparkSession)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)
