"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings the plans are written for. AQE turns over-estimated joins into broadcast joins,
# merges small shuffle partitions and splits skewed ones, also where that costs another shuffle. Columnar
# files grow about fourfold when read, so the size estimate behind a broadcast counts them at that.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "siftload", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_area: ContextVar[str | None] = ContextVar("siftload_work_area", default=None)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_area(spark: SparkSession) -> Iterator[str]:
    """Work folders made inside the block lie in one folder, which is removed at its end."""
    folder = work_dir(spark)
    token = _area.set(folder)
    try:
        yield folder
    finally:
        _area.reset(token)
        delete_folder(spark, folder)


def work_dir(spark: SparkSession) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    if area := _area.get():
        return f"{area}/{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="siftload-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/siftload-{uuid.uuid4().hex}"
