"""The anomaly profile of a stream, equal to that of all its records in one batch.

Each micro-batch stores what merges: deliveries and flags by record hash, and
its blocks of arrivals with the event times at their edges. The profile sums
the flags (a hash seen in several batches is a duplicate there too) and walks
the blocks of each source partition in order of their first offset, so the last
event time of a batch is carried to the next whichever way the stream is cut,
and in whatever order the batches ran. A batch takes a contiguous range of
offsets of each source partition, as a topic source gives it. A replayed batch
overwrites its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterbill.operators.quality import FLAGS, arrival_blocks, hash_flags, merged_flags, out_of_order_total, profile_of
from meterbill.sources.cdr import decode_cdr
from meterbill.sources.tables import empty_frame, path_exists
from meterbill.streaming.mediation import DEFAULT_TRIGGER, stream_id

HASHES = T.StructType([T.StructField("record_hash", T.StringType()), *[T.StructField(c, T.LongType()) for c in FLAGS]])
BLOCKS = T.StructType([T.StructField("source", T.LongType()), T.StructField("first_at", T.LongType()), T.StructField("late", T.LongType()),
                       T.StructField("first_time", T.TimestampType()), T.StructField("last_time", T.TimestampType())])


def profile_batch_writer(out: str, checkpoint: str, order_col: str = "offset", partition_col: str | None = None):
    """foreachBatch function over messages (``value`` and the offset columns)."""
    keep = (order_col,) if partition_col is None else (order_col, partition_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        at = f"stream={stream_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}"
        decoded = decode_cdr(batch, keep=keep)
        hash_flags(decoded).select(*HASHES.names).write.mode("overwrite").parquet(f"{out}/hashes/{at}")
        arrival_blocks(decoded, order_col, partition_col).select(*BLOCKS.names).write.mode("overwrite").parquet(f"{out}/blocks/{at}")
    return write


def start_anomaly_profile(raw: DataFrame, out: str, checkpoint: str, order_col: str = "offset", partition_col: str | None = None,
                          trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False) -> StreamingQuery:
    w = raw.writeStream.foreachBatch(profile_batch_writer(out, checkpoint, order_col, partition_col)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stream_anomaly_profile(spark: SparkSession, out: str) -> DataFrame:
    """The one-row profile of everything that the stream has taken so far."""
    per_hash = merged_flags(_stored(spark, f"{out}/hashes", HASHES))
    return profile_of(per_hash, out_of_order_total(_stored(spark, f"{out}/blocks", BLOCKS)))
