"""Named source tables: Parquet folders, catalog tables or JDBC queries behind one registry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftload.sources.owned import OwnedRows

# Largest row count that may be sent to every executor. Code dictionaries, users and product lists
# stay far below; a table beyond it is joined by shuffle instead.
MAX_BROADCAST_ROWS = 500_000
# And its largest size: rows times what a row of the schema takes, longer texts counted as they are.
MAX_BROADCAST_BYTES = 256 << 20


def estimated_small(df: DataFrame) -> bool:
    """Will Spark broadcast ``df`` by its own size estimate anyway? Not known on a remote session."""
    if not hasattr(df, "_jdf"):
        return False
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Counts and measures at most ``max_rows + 1`` rows, so the check stays cheap on a table that is too big."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    size = F.lit(16 * len(df.columns) + 16)
    for text in texts:
        size = size + text
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= MAX_BROADCAST_BYTES


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when its counted size allows it, else ``df`` as it is."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


class Tables:
    """Logical table name to DataFrame. Names may carry a namespace: ``crm.account``.

    ``tables["x"]`` is the plain frame. ``tables.lookup("x")`` is the frame for the small side of a
    join: a table that Spark estimates to be small needs no hint; any other carries a broadcast hint only
    if a count has shown it to be small, and is joined by shuffle if not.
    """

    def __init__(self, frames: Mapping[str, DataFrame] | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self._frames: dict[str, DataFrame] = dict(frames or {})
        self._small: dict[str, bool] = {}
        self._owned: dict[str, OwnedRows] = {}
        self.max_broadcast_rows = max_broadcast_rows

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError:
            raise KeyError(f"table {name!r} is not registered; known: {sorted(self._frames)}") from None

    def __contains__(self, name: str) -> bool:
        return name in self._frames

    def replaced(self, name: str, df: DataFrame) -> Tables:
        """The same tables with another frame under one name."""
        out = Tables({**self._frames, name: df}, self.max_broadcast_rows)
        out._owned = {k: v for k, v in self._owned.items() if k != name}
        return out

    def with_owned(self, owned: Mapping[str, OwnedRows]) -> Tables:
        """The same tables, some of which are also laid out by owner."""
        out = Tables(self._frames, self.max_broadcast_rows)
        out._owned = {**self._owned, **owned}
        return out

    def rows_of(self, name: str, owner: str, wanted: DataFrame, key: str) -> DataFrame:
        """Rows of ``name`` whose owner is among the values of ``key``: without a shuffle of the rows where they are laid out by owner."""
        laid_out = self._owned.get(name)
        if laid_out is not None and laid_out.owner == owner:
            return laid_out.of(wanted, key)
        ids = wanted.select(F.col(key).alias("__id"))
        return self[name].join(ids, F.col(owner) == F.col("__id"), "left_semi")

    def names(self) -> list[str]:
        return sorted(self._frames)

    def register(self, name: str, df: DataFrame) -> Tables:
        self._frames[name] = df
        self._small.pop(name, None)
        self._owned.pop(name, None)
        return self

    def register_namespace(self, namespace: str, other: Tables) -> Tables:
        for name in other.names():
            self.register(f"{namespace}.{name}", other[name])
        return self

    def lookup(self, name: str) -> DataFrame:
        df = self[name]
        if estimated_small(df):
            return df
        if name not in self._small:
            self._small[name] = fits_broadcast(df, self.max_broadcast_rows)
        return F.broadcast(df) if self._small[name] else df


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str], suffix: str = ".parquet") -> Tables:
    return Tables({n: spark.read.parquet(f"{folder.rstrip('/')}/{n}{suffix}") for n in names})


def catalog_tables(spark: SparkSession, names: Mapping[str, str] | Iterable[str]) -> Tables:
    """Logical name to ``catalog.namespace.table``."""
    pairs = names.items() if isinstance(names, Mapping) else ((n, n) for n in names)
    return Tables({logical: spark.table(physical) for logical, physical in pairs})


def jdbc_options(
    url: str,
    *,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 64,
    fetch_size: int = 15_000,
    single_task: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read. With a partition column the read is split over executors.

    Spark takes ``partitionColumn`` only together with ``dbtable``, so a query then becomes a derived table.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **extra}
    if partition_column is None:
        if not single_task:
            raise ValueError("name a partition column, or say single_task=True for a read in one task")
        options.update({"query": query} if query else {"dbtable": table})
        return options
    if bounds is None:
        raise ValueError("a partitioned read needs the bounds of its partition column")
    options.update(
        dbtable=table or f"({query}) src",
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(num_partitions),
    )
    return options


def jdbc_table(spark: SparkSession, url: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()
