"""Run audit: one row per load, and the row count without a second run of the plan."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = "name string, started_at timestamp_ntz, ended_at timestamp_ntz, rows bigint, seconds double, message string, error string, run string"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunAudit:
    """Appends a row per load to a Parquet folder. A failed load is recorded and then raised again.

    ``run`` names the run that the loads belong to, so that it can be taken up again (``finished``).
    """

    def __init__(self, spark: SparkSession, path: str, run: str | None = None):
        self.spark = spark
        self.path = path
        self.run_id = run

    def _append(self, *row) -> None:
        self.spark.createDataFrame([(*row, self.run_id)], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def message(self, name: str, text: str) -> None:
        now = _now()
        self._append(name, now, now, None, None, text, None)

    def run(self, name: str, build: Callable[[], DataFrame], load: Callable[[DataFrame], object]) -> int:
        """Builds the extract, loads it, records the rows counted while they were written."""
        started = _now()
        seen = Observation(f"rows of {name}")
        try:
            load(build().observe(seen, F.count(F.lit(1)).alias("rows")))
            rows = seen.get["rows"]
        except Exception as error:
            ended = _now()
            self._append(name, started, ended, None, (ended - started).total_seconds(), None, str(error))
            raise
        ended = _now()
        self._append(name, started, ended, rows, (ended - started).total_seconds(), None, None)
        return rows

    def read(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path)

    def finished(self) -> set[str]:
        """Names of the loads that this run has finished, in this process or before it stopped."""
        if self.run_id is None:
            return set()
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return set()
        done = self.read().where((F.col("run") == self.run_id) & F.col("error").isNull() & F.col("rows").isNotNull())
        return {r["name"] for r in done.select("name").distinct().collect()}  # one per plan
