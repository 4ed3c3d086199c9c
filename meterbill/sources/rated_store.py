"""The rated history, laid out for the question "was this record rated?".

A table bucketed by ``record_hash`` and partitioned by run and usage month. A
join on the hash reads a bucket where it lies: the history, however long, is
never shuffled, only the new records are. Months that the new records do not
touch are pruned as partitions; of the others the join reads the hash column
alone. Appends are repeatable (``commits.py``).

Bucketing belongs to a table definition, so the store has a name in the
session's catalog; ``RatedStore`` makes it anew over the folder where the
catalog does not keep it. The bucket count is fixed for a store's life: about
the hash bytes of all months that a run reads, over 128 MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.schemas import RATED_CDR
from meterbill.sources.commits import RUN, check_run, commit, committed_runs, discard, is_committed
from meterbill.sources.sinks import USAGE_MONTH
from meterbill.sources.tables import path_exists


class RatedStore:
    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 200):
        self.spark, self.name, self.path, self.buckets = spark, name, path.rstrip("/"), buckets
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATED_CDR.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {RUN} STRING, {USAGE_MONTH} DATE) USING parquet "
                  f"PARTITIONED BY ({RUN}, {USAGE_MONTH}) "
                  f"CLUSTERED BY (record_hash) SORTED BY (record_hash) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
        if path_exists(spark, self.path):
            spark.catalog.recoverPartitions(name)        # those that other sessions wrote

    def append(self, rated: DataFrame, run: str) -> bool:
        """Append rated rows as ``run`` (one file for each bucket and month); False
        if the run is committed already. Rows without a time have no month."""
        if is_committed(self.spark, self.path, check_run(run)):
            return False
        discard(self.spark, self.path, run)
        rows = rated.select(*[f.name for f in RATED_CDR.fields], F.lit(run).alias(RUN),
                            F.trunc(F.col("timestamp").cast("date"), "MM").alias(USAGE_MONTH))
        rows.repartition(self.buckets, "record_hash").write.insertInto(self.name)
        commit(self.spark, self.path, run)
        self.spark.catalog.refreshTable(self.name)
        return True

    def read(self) -> DataFrame:
        """All committed rows, with ``run`` and ``usage_month``."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col(RUN).isin(committed_runs(self.spark, self.path)))
