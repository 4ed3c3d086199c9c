"""Table scans: whole table, with a pushed-down predicate, or empty-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(root: str, name: str) -> str:
    root = root.rstrip("/")
    return f"{root}/{name}.parquet" if not name.endswith(".parquet") else f"{root}/{name}"


def read_table(spark: SparkSession, root: str, name: str,
               where: str | Column | None = None, fmt: str = "parquet",
               options: dict[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read a table; ``where`` is applied lazily so Catalyst pushes it into
    the scan (parquet row-group statistics, JDBC WHERE clause). A declared
    ``schema`` skips schema inference (no footer reads at planning time)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "jdbc":
        df = reader.option("dbtable", name).load()
    else:
        df = reader.load(table_path(root, name) if fmt == "parquet" else f"{root.rstrip('/')}/{name}")
    return df.where(where) if where is not None else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the path (works for
    local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty frame the optimizer can see is empty (it folds to an
    empty local relation), so joins and unions against it are pruned at
    planning time instead of shuffling the other side."""
    return (spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
            .where(F.lit(False)))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` when the table
    does not exist yet. Any other read error propagates."""
    if path_exists(spark, path):
        return spark.read.format(fmt).schema(schema).load(path)
    return empty_frame(spark, schema)


def cached(df: DataFrame) -> DataFrame:
    """Keep a reused frame in executor memory (spilling to disk)."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class TtlCache:
    """A frame cached for ``ttl_s`` seconds, then rebuilt from ``loader``.

    The data stays on the executors (persist); the driver only keeps the
    handle and its age. On expiry the old copy is unpersisted and the
    loader re-runs, so a refreshed source is picked up.
    """

    def __init__(self, loader, ttl_s: float = 300.0, clock=None):
        import time
        self._loader, self._ttl, self._clock = loader, ttl_s, clock or time.monotonic
        self._df: DataFrame | None = None
        self._born = 0.0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._born >= self._ttl:
            self.invalidate()
            self._df, self._born = cached(self._loader()), now
        return self._df

    def invalidate(self) -> None:
        if self._df is not None:
            self._df.unpersist()
            self._df = None


_CACHES: dict[tuple, TtlCache] = {}
MAX_CACHES = 32


def shared_cache(spark: SparkSession, key: str, loader, ttl_s: float = 300.0) -> TtlCache:
    """The session's cache of ``key``; the oldest ones beyond ``MAX_CACHES``
    are released from the executors."""
    at = (spark.sparkContext.applicationId, key)
    if at not in _CACHES:
        while len(_CACHES) >= MAX_CACHES:
            _CACHES.pop(next(iter(_CACHES))).invalidate()
        _CACHES[at] = TtlCache(loader, ttl_s)
    return _CACHES[at]
