"""Mediation: raw usage records -> validated, de-duplicated normalized CDRs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.schemas import (BLOCKED_PREFIX, HASH_SEPARATOR, NORMALIZED_COLUMNS,
                               STATUS_ERROR, STATUS_OK, VALID_MSISDN_PATTERN)


def normalize_parties(df: DataFrame) -> DataFrame:
    """msisdn = caller, else sender, else user; peer = callee, else receiver."""
    return df.withColumns({
        "msisdn": F.coalesce("caller_id", "sender_id", "user_id"),
        "peer_id": F.coalesce("callee_id", "receiver_id"),
    })


def _measures_negative() -> F.Column:
    return (F.col("duration_sec") < 0) | (F.col("data_volume_mb") < 0) | (F.col("session_duration_sec") < 0)


def reject_reason() -> F.Column:
    """First failing rule, or NULL. NULL measures pass (three-valued OR)."""
    m = F.col("msisdn")
    return (F.when(m.isNull(), "null_msisdn")
            .when(~m.rlike(VALID_MSISDN_PATTERN), "bad_prefix")
            .when(m.startswith(BLOCKED_PREFIX), "blocked_prefix")
            .when(_measures_negative(), "negative_measure"))


def validate(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(reject_reason().isNull(), STATUS_OK).otherwise(STATUS_ERROR))


def with_record_hash(df: DataFrame) -> DataFrame:
    """SHA-256 of timestamp|msisdn|record_type on the raw strings; NULL parts
    are skipped by concat_ws."""
    # never null, and declared so: else a join on it infers "is not null", which
    # the planner moves down to the scan with all of the decoding inside
    return df.withColumn("record_hash", F.coalesce(F.sha2(
        F.concat_ws(HASH_SEPARATOR, "timestamp", "msisdn", "record_type"), 256), F.lit("")))


def deduplicate(df: DataFrame) -> DataFrame:
    """Keep one row per record_hash, over all statuses.

    Batch: a group-by with a deterministic winner -- ok before error, then
    the output columns in order (NULLs first), then the remaining columns.
    ``min(struct)`` is combined map-side before the shuffle, so a hash that
    holds a large share of the rows still costs one row per map task.
    Streaming frames get the stateful streaming dedup instead.
    """
    if df.isStreaming:
        from meterbill.streaming.mediation import dedup_stream
        return dedup_stream(df)
    out_cols = [c for c in NORMALIZED_COLUMNS if c in df.columns and c != "record_hash"]
    rest = [c for c in df.columns if c not in out_cols and c != "record_hash"]
    rank = F.when(F.col("status") == STATUS_OK, 0).otherwise(1).alias("_rank")
    winner = F.min(F.struct(rank, *out_cols, *rest)).alias("_w")
    return (df.groupBy("record_hash").agg(winner)
              .select(*[F.col(f"_w.{c}").alias(c) for c in out_cols + rest], "record_hash")
              .select(*df.columns))


def keep_valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == STATUS_OK)


def to_normalized(df: DataFrame) -> DataFrame:
    """The 11 normalized_cdr columns; the timestamp string becomes a
    timestamp (try_cast: a malformed value yields NULL, not an error)."""
    cols = [F.expr("try_cast(timestamp AS TIMESTAMP)").alias("timestamp") if c == "timestamp" else F.col(c)
            for c in NORMALIZED_COLUMNS]
    return df.select(*cols)


def mediate_all(decoded: DataFrame) -> DataFrame:
    """parties -> status -> hash -> dedup (all statuses kept)."""
    return deduplicate(with_record_hash(validate(normalize_parties(decoded))))


def mediate(decoded: DataFrame) -> DataFrame:
    """Decoded raw records -> normalized_cdr rows (status ok)."""
    return to_normalized(keep_valid(mediate_all(decoded)))
