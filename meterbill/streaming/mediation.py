"""Structured Streaming mediation: lossless dedup, exactly-once sinks, stop."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DEFAULT_TRIGGER = "10 seconds"
WRITERS_A_DATE = 4


def dedup_stream(df: DataFrame) -> DataFrame:
    """Stateful dedup on record_hash: the first delivery of a hash passes,
    however late it comes and whether or not its timestamp parses. No row is
    lost, so every hash stays in the state store (RocksDB, on disk); for a
    stream without end use the ``anti_join`` sink, which keeps no state."""
    return df.dropDuplicates(["record_hash"])


def null_time_rows(df: DataFrame) -> DataFrame:
    """Rows whose timestamp does not parse."""
    return df.where(F.expr("try_cast(timestamp AS TIMESTAMP)").isNull())


def _event_date():
    return F.to_date(F.expr("try_cast(timestamp AS TIMESTAMP)"))     # raw frames carry a string


def stream_id(spark, checkpoint: str) -> str:
    """The query id kept in a checkpoint: the same after a restart, another
    one for a new checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata", schema="id string").first()["id"]


def idempotent_batch_writer(out_path: str, checkpoint: str, fmt: str = "parquet"):
    """foreachBatch function: each micro-batch overwrites its own
    ``stream=<query id>/batch_id=N`` folder. A batch replayed after a failure
    replaces its partial output; a new checkpoint, whose batch ids start at 0
    again, writes beside what earlier ones left."""
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out_path}/stream={stream_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}"
        batch.write.mode("overwrite").format(fmt).save(folder)
    return write


def anti_join_batch_writer(out_path: str, checkpoint: str):
    """foreachBatch function that dedups without state: a batch loses its own
    copies, then the hashes that earlier batches stored. Copies of a record
    have one timestamp, so only the stored event dates of the batch are read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        from meterbill.sources.tables import path_exists
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        from meterbill.operators.mediation import deduplicate
        new = deduplicate(batch).withColumn("event_date", F.coalesce(_event_date().cast("string"), F.lit("none")))
        kept = new = new.persist(StorageLevel.DISK_ONLY)        # its dates are read first, then its rows
        if path_exists(spark, out_path):
            stored = spark.read.option("basePath", out_path).schema(
                "record_hash string, stream string, batch_id long, event_date string").parquet(f"{out_path}/stream=*")
            earlier = stored.where(~((F.col("stream") == stream) & (F.col("batch_id") == batch_id)))
            dates = [r[0] for r in new.select("event_date").distinct().collect()]     # days of one batch
            earlier = earlier.where(F.col("event_date").isin(dates)).select("record_hash")
            new = new.join(earlier, "record_hash", "left_anti").select(*new.columns)
        (new.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date")
            .parquet(f"{out_path}/stream={stream}/batch_id={batch_id}"))
        kept.unpersist()
    return write


def start_mediation(df: DataFrame, out_path: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                    available_now: bool = False, fmt: str = "parquet", sink: str = "files",
                    writers_a_date: int = WRITERS_A_DATE) -> StreamingQuery:
    """Run the mediated stream into ``out_path`` with a checkpoint (offset
    and commit logs give restart recovery).

    ``sink="files"`` (default): Spark's file sink, exactly-once through its
    own metadata log, one folder per event date (``event_date``), so readers
    prune by date and no folder per micro-batch piles up. A batch's rows of one
    date meet in at most ``writers_a_date`` tasks: not a file for each task and
    date, and a date that holds nearly all rows is still written in parallel.
    ``sink="foreach_batch"``: each micro-batch goes through
    ``idempotent_batch_writer`` -- the shape to use for external sinks
    (e.g. a JDBC append) that need per-batch code.
    ``sink="anti_join"``: ``anti_join_batch_writer``, for a stream that is not
    de-duplicated yet.
    """
    if sink == "files":
        share = F.pmod(F.xxhash64(*df.columns), F.lit(writers_a_date))
        w = (df.withColumn("event_date", _event_date()).repartition(F.col("event_date"), share).writeStream.format(fmt)
             .option("path", out_path).partitionBy("event_date").outputMode("append"))
    elif sink == "foreach_batch":
        w = df.writeStream.foreachBatch(idempotent_batch_writer(out_path, checkpoint, fmt))
    elif sink == "anti_join":
        w = df.writeStream.foreachBatch(anti_join_batch_writer(out_path, checkpoint))
    else:
        raise ValueError(f"unknown sink {sink!r}")
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def stop(query: StreamingQuery, timeout_s: float = 30.0, poll_s: float = 0.05) -> bool:
    """Graceful stop between micro-batches: wait until no batch is running (at
    most ``timeout_s``), then stop. True if no batch had to be aborted."""
    deadline = time.monotonic() + timeout_s
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(poll_s)
    idle = not (query.isActive and query.status["isTriggerActive"])
    query.stop()
    return idle
