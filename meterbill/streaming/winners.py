"""A mediated stream whose result does not depend on the order of arrival.

Copies of a record may differ, and the batch rule picks one of all of them (ok
before error, then by columns). A stream cannot know the best copy when the
first one comes, so it keeps versions: each micro-batch writes the winner of
its own copies of a hash, and ``read_winners`` applies the same rule to what
the batches wrote. A minimum of minima is the minimum: any cut into batches
and any order give the batch result, late rows and rows without a time too.
Nothing stored is ever read by the stream, so a day costs what arrives on it.

``dedup_stream(df, delay)`` in front bounds the volume: copies equal in every
column, up to ``delay`` apart in arrival, are dropped by a state store that
forgets a row when ``delay`` has passed. Later copies pass and lose in
``read_winners``; no row is late, because time is arrival time.

Folders: ``stream=<query id>/batch_id=N/arrival_date=/event_date=``. A replayed
batch overwrites its own. ``accounting`` writes a row a batch beside them, in
the same step, whose counts add up to the messages read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterbill.operators.mediation import deduplicate, normalize_parties, to_normalized, validate, with_record_hash
from meterbill.schemas import NORMALIZED_CDR, STATUS_OK
from meterbill.sources.cdr import decode_cdr
from meterbill.sources.tables import empty_frame, path_exists
from meterbill.streaming.mediation import DEFAULT_TRIGGER, WRITERS_A_DATE, stream_id

ACCOUNTS = "_accounts"           # hidden from readers of the rows
STORED = T.StructType([*NORMALIZED_CDR.fields, T.StructField("arrival_date", T.DateType()), T.StructField("event_date", T.DateType())])
ACCOUNT = T.StructType([T.StructField(n, T.LongType()) for n in ("decoded", "rejected", "repeated", "stored", "untimed", "late")]
                       + [T.StructField("last_event", T.TimestampType()), T.StructField("stream", T.StringType()),
                          T.StructField("batch_id", T.LongType())])


def dedup_stream(df: DataFrame, delay: str, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Drop copies of a row (equal in ``keys``, default all columns) that arrive
    within ``delay`` of the first. The state holds the rows of about ``delay``,
    however long the stream runs; copies further apart all pass."""
    keyed = df.withColumns({"_copy": F.sha2(F.to_json(F.struct(*(keys or df.columns))), 256), "_arrived": F.current_timestamp()})
    return keyed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_copy"]).drop("_copy", "_arrived")


def checked(raw: DataFrame) -> DataFrame:
    """Messages -> decoded rows with parties, status and hash; nothing dropped."""
    return with_record_hash(validate(normalize_parties(decode_cdr(raw))))


def batch_winners(rows: DataFrame, statuses: tuple[str, ...] = (STATUS_OK,)) -> DataFrame:
    """One normalized row for each hash of a batch of ``checked`` rows."""
    return to_normalized(deduplicate(rows.where(F.col("status").isin(*statuses))))


def _event_date() -> F.Column:
    return F.to_date("timestamp")


def by_date(won: DataFrame) -> DataFrame:
    """A date's rows in few tasks: not a file for each task and date. Spark turns
    adaptive execution off for the batches of a stream with state, and ignores
    the hint then; there a date's rows meet in at most ``WRITERS_A_DATE`` tasks."""
    if won.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return won.hint("rebalance", "event_date")
    return won.repartition("event_date", F.pmod(F.xxhash64("record_hash"), F.lit(WRITERS_A_DATE)))


def _write_account(spark: SparkSession, rows: DataFrame, stored: int, out: str, stream: str, batch_id: int, delay: str) -> None:
    when = F.expr("try_cast(timestamp AS TIMESTAMP)")
    earlier = read_accounts(spark, out).where((F.col("stream") == stream) & (F.col("batch_id") < batch_id)).agg(F.max("last_event")).first()[0]
    late = F.lit(False) if earlier is None else F.coalesce(when < F.lit(earlier) - F.expr(f"INTERVAL {delay}"), F.lit(False))
    counts = rows.agg(F.count("*").alias("decoded"), F.count_if(F.col("status") != STATUS_OK).alias("rejected"),
                      F.count_if(when.isNull()).alias("untimed"), F.count_if(late).alias("late"), F.max(when).alias("last_event"))
    account = counts.select("decoded", "rejected", (F.col("decoded") - F.col("rejected") - stored).alias("repeated"),
                            F.lit(stored).cast("long").alias("stored"), "untimed", "late", "last_event")
    account.write.mode("overwrite").json(f"{out}/{ACCOUNTS}/stream={stream}/batch_id={batch_id}")


def winner_batch_writer(out: str, checkpoint: str, accounting: bool = False, delay: str = "1 hour",
                        statuses: tuple[str, ...] = (STATUS_OK,)):
    """foreachBatch function over ``checked`` rows of these ``statuses``. With ``accounting`` a row
    whose event time lies more than ``delay`` before the last one of earlier
    batches counts as late; it is stored like any other."""
    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark import StorageLevel
        spark, stream = batch.sparkSession, stream_id(batch.sparkSession, checkpoint)
        folder = f"{out}/stream={stream}/batch_id={batch_id}"
        rows = batch.persist(StorageLevel.DISK_ONLY) if accounting else batch       # read twice
        won = batch_winners(rows, statuses).withColumns({"arrival_date": F.current_date(), "event_date": _event_date()})
        by_date(won).write.mode("overwrite").partitionBy("arrival_date", "event_date").parquet(folder)
        if accounting:
            _write_account(spark, rows, spark.read.schema(STORED).parquet(folder).count(), out, stream, batch_id, delay)
            rows.unpersist()
    return write


def start_winners(raw: DataFrame, out: str, checkpoint: str, delay: str | None = None, accounting: bool = False,
                  statuses: tuple[str, ...] = (STATUS_OK,),
                  trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False) -> StreamingQuery:
    """Mediate the message stream ``raw`` into versions at ``out``. With ``delay``
    copies that arrive within it are dropped first (they are not decoded rows to
    the accounts then). The accounts take ``stored`` as ok rows: they need the
    default ``statuses``."""
    if accounting and statuses != (STATUS_OK,):
        raise ValueError("accounts are kept of streams that store ok rows alone")
    rows = checked(raw)
    if delay is not None:
        rows = dedup_stream(rows, delay)
    w = rows.writeStream.foreachBatch(winner_batch_writer(out, checkpoint, accounting, statuses=statuses)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def read_versions(spark: SparkSession, out: str) -> DataFrame:
    """What the batches stored: a hash has a row for each batch that held it."""
    if not path_exists(spark, out):
        return empty_frame(spark, STORED)
    return spark.read.schema(STORED).option("basePath", out).parquet(f"{out}/stream=*").select(*[f.name for f in STORED.fields])


def winners_of(versions: DataFrame) -> DataFrame:
    """The batch rule over versions; combined before the shuffle. Copies share
    their event date, so a filter on it may come before."""
    return deduplicate(versions.select(*[f.name for f in NORMALIZED_CDR.fields]))


def read_winners(spark: SparkSession, out: str) -> DataFrame:
    """normalized_cdr as mediation of all messages in one batch gives it."""
    return winners_of(read_versions(spark, out))


def read_accounts(spark: SparkSession, out: str) -> DataFrame:
    """A row a batch: messages decoded = rejected + repeated in the batch + stored."""
    path = f"{out}/{ACCOUNTS}"
    if not path_exists(spark, path):
        return empty_frame(spark, ACCOUNT)
    return spark.read.schema(ACCOUNT).json(path)


def account_totals(spark: SparkSession, out: str) -> DataFrame:
    """One row over all batches: ``decoded = rejected + duplicates + records``,
    duplicates within batches and between them."""
    parts = ("decoded", "rejected", "repeated", "stored", "untimed")
    zero = F.lit(0).cast("long")
    sums = read_accounts(spark, out).select(*parts, zero.alias("records"))
    records = read_versions(spark, out).agg(F.count_distinct("record_hash").alias("records")).select(*[zero.alias(c) for c in parts], "records")
    total = sums.unionByName(records).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in (*parts, "records")])
    return total.select("decoded", "rejected", (F.col("repeated") + F.col("stored") - F.col("records")).alias("duplicates"),
                        "records", "untimed")


# -- counts by day and status, kept up to date from the versions --------------

_SEEN = T.StructType([T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())])
DAILY = T.StructType([T.StructField("status", T.StringType()), T.StructField("count", T.LongType()), T.StructField("event_date", T.DateType())])


def refresh_daily_counts(spark: SparkSession, out: str, counts: str) -> int:
    """Bring the counts at ``counts`` up to date with the versions at ``out``;
    returns how many days were counted anew.

    Only days that batches since the last refresh wrote to are read (the batches
    and their days are folder names), and their counts replaced; the batches are
    noted last. Run twice, or again after a failure, it gives the same table. It
    runs as often as the figures should be fresh, not with each batch.
    """
    if not path_exists(spark, out):
        return 0
    schema = T.StructType([*STORED.fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())])
    stored = spark.read.schema(schema).option("basePath", out).parquet(f"{out}/stream=*")
    noted = f"{counts}/_batches"
    seen = spark.read.schema(_SEEN).parquet(noted) if path_exists(spark, noted) else empty_frame(spark, _SEEN)
    last = {r["stream"]: r["n"] for r in seen.groupBy("stream").agg(F.max("batch_id").alias("n")).collect()}    # a row a checkpoint
    new = F.lit(True)
    for stream, n in last.items():
        new = new & ~((F.col("stream") == stream) & (F.col("batch_id") <= n))
    touched = stored.where(new).select("stream", "batch_id", "event_date").distinct().collect()                 # folder names
    dates = sorted({r["event_date"] for r in touched if r["event_date"] is not None})
    if dates:
        daily = winners_of(stored.where(F.col("event_date").isin(dates))).groupBy("status", F.to_date("timestamp").alias("event_date")).agg(
            F.count("*").alias("count"))
        (daily.select(*DAILY.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("event_date").parquet(counts))
    if touched:
        rows = sorted({(r["stream"], r["batch_id"]) for r in touched})
        spark.createDataFrame(rows, _SEEN).coalesce(1).write.mode("append").parquet(noted)
    return len(dates)


def daily_counts(spark: SparkSession, counts: str) -> DataFrame:
    """``date, status, count`` of all days that have a time."""
    if not path_exists(spark, counts):
        return empty_frame(spark, DAILY).select(F.col("event_date").alias("date"), "status", "count")
    return spark.read.schema(DAILY).parquet(counts).select(F.col("event_date").alias("date"), "status", "count")
