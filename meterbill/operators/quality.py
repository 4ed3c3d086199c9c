"""Data-quality profiles: reject reasons, injected anomaly kinds, constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.operators.mediation import normalize_parties, reject_reason, validate, with_record_hash
from meterbill.schemas import CUSTOMER_STATUSES, PRIMARY_KEYS, SERVICES, SUBSCRIPTION_TYPES

# Required fields of each record shape (unknown types are checked as voice).
SHAPE_FIELDS = {
    "voice": ["caller_id", "callee_id", "duration_sec", "cell_id", "technology"],
    "sms": ["sender_id", "receiver_id", "cell_id", "technology"],
    "data": ["user_id", "data_volume_mb", "session_duration_sec", "cell_id", "technology"],
}
FLAGS = ("_n", "_m", "_c", "_u")
ARRIVAL_BLOCK = 1 << 22   # rows per ordered block of the out-of-order scan


def reject_profile(decoded: DataFrame) -> DataFrame:
    """Rows per status and first failing rule."""
    v = validate(normalize_parties(decoded))
    return (v.groupBy("status", F.coalesce(reject_reason(), F.lit("none")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("records")))


def _missing_field() -> F.Column:
    rt = F.col("record_type")
    by_shape = F.lit(False)
    for shape, fields in SHAPE_FIELDS.items():
        absent = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])
        match = (rt == shape) if shape != "voice" else ~rt.isin("sms", "data")
        by_shape = F.when(match, absent).otherwise(by_shape)
    return rt.isNull() | F.col("timestamp").isNull() | by_shape


def _corrupted() -> F.Column:
    party = F.coalesce("caller_id", "sender_id", "user_id")
    neg = (F.col("duration_sec") < 0) | (F.col("data_volume_mb") < 0) | (F.col("session_duration_sec") < 0)
    return F.coalesce(neg, F.lit(False)) | F.coalesce(~party.rlike(r"^\+?[0-9]+$"), F.lit(False))


def out_of_order_count(decoded: DataFrame, order_col: str = "offset",
                       partition_col: str | None = None) -> DataFrame:
    """Rows whose event time is earlier than the previous row's in arrival
    order (within a source partition when ``partition_col`` is given, e.g.
    the topic partition: offsets restart in every partition, and arrival
    order is only defined inside one).

    The lag runs inside fixed arrival blocks of ``ARRIVAL_BLOCK`` offsets, so
    no task holds more than one block; the first row of each block compares
    with the last row of the preceding non-empty block of the same source
    partition, taken from a per-block summary (one row per block).
    """
    return out_of_order_total(arrival_blocks(decoded, order_col, partition_col))


def arrival_blocks(decoded: DataFrame, order_col: str = "offset", partition_col: str | None = None) -> DataFrame:
    """One row for each block of arrivals: ``source, first_at, late, first_time,
    last_time`` (rows earlier than their predecessor within the block, event
    times of its first and last row)."""
    ts = F.expr("try_cast(timestamp AS TIMESTAMP)")
    part = F.col(partition_col).cast("long") if partition_col else F.lit(0).cast("long")
    x = decoded.select(part.alias("source"), F.col(order_col).alias("_o"), ts.alias("_ts"),
                       F.floor(F.col(order_col) / ARRIVAL_BLOCK).alias("_b"))
    w = Window.partitionBy("source", "_b").orderBy("_o", "_ts")
    x = x.withColumn("_late", (F.col("_ts") < F.lag("_ts").over(w)).cast("int"))
    return x.groupBy("source", "_b").agg(
        F.min("_o").cast("long").alias("first_at"), F.coalesce(F.sum("_late"), F.lit(0)).cast("long").alias("late"),
        F.min(F.struct("_o", "_ts"))["_ts"].alias("first_time"), F.max(F.struct("_o", "_ts"))["_ts"].alias("last_time")).drop("_b")


def out_of_order_total(blocks: DataFrame) -> DataFrame:
    """``out_of_order`` of all arrivals from their blocks: the first row of a block
    is compared with the last of the block before it in its source partition."""
    carry = F.lag("last_time").over(Window.partitionBy("source").orderBy("first_at"))
    edges = blocks.withColumn("_edge", F.coalesce((F.col("first_time") < carry).cast("int"), F.lit(0)))
    return edges.agg(F.coalesce(F.sum(F.col("late") + F.col("_edge")), F.lit(0)).cast("bigint").alias("out_of_order"))


def anomaly_profile(decoded: DataFrame, order_col: str = "offset",
                    partition_col: str | None = None) -> DataFrame:
    """Counts of the five anomaly kinds: missing fields, corrupted values,
    unknown record types, duplicate deliveries (extra copies per record
    hash), out-of-order arrivals.

    Two passes over the messages: one group-by on the record hash that
    also carries the per-row flags as partial sums (combined map-side, so a
    hash with very many copies stays one row per task), and the ordered
    arrival scan.
    """
    per_hash = hash_flags(decoded)
    return profile_of(per_hash, out_of_order_count(decoded, order_col, partition_col))


def hash_flags(decoded: DataFrame) -> DataFrame:
    """For each record hash: deliveries, and how many of them miss fields, are
    corrupted, are of an unknown type. Sums of it merge."""
    rt = F.col("record_type")
    flagged = with_record_hash(normalize_parties(decoded)).select(
        "record_hash",
        _missing_field().cast("int").alias("_m"),
        _corrupted().cast("int").alias("_c"),
        (rt.isNotNull() & ~rt.isin(*SERVICES)).cast("int").alias("_u"))
    return merged_flags(flagged.withColumn("_n", F.lit(1)))


def merged_flags(flags: DataFrame) -> DataFrame:
    return flags.groupBy("record_hash").agg(*[F.sum(c).alias(c) for c in FLAGS])


def profile_of(per_hash: DataFrame, ooo: DataFrame) -> DataFrame:
    """The profile from a row for each hash and the out-of-order total."""
    counts = per_hash.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum("_m"), F.lit(0)).cast("bigint").alias("missing_fields"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("corrupted_values"),
        F.coalesce(F.sum("_u"), F.lit(0)).cast("bigint").alias("unknown_types"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    # two one-row frames stacked and folded (no join needed)
    cols = ["total_records", "missing_fields", "corrupted_values", "unknown_types", "duplicates", "out_of_order"]

    def pad(df):
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("bigint").alias(c) for c in cols])
    return pad(counts).unionByName(pad(ooo)).agg(*[F.max(c).alias(c) for c in cols])


def _pk_violations(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(any_null).alias("_null"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n")).otherwise(F.col("_n") - 1)), F.lit(0))
                 .cast("bigint").alias("violations")) \
        .select(F.lit(name).alias("table_name"), F.lit("primary_key").alias("check_name"), "violations")


def _count_where(name: str, check: str, df: DataFrame, bad: F.Column) -> DataFrame:
    return df.agg(F.count(F.when(bad, 1)).alias("violations")) \
        .select(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"), "violations")


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary-key uniqueness for every table given, the tariff -> plan
    foreign key, and the CHECK value sets."""
    parts = [_pk_violations(n, tables[n], PRIMARY_KEYS[n]) for n in PRIMARY_KEYS if n in tables]
    if "product_rates" in tables and "rate_plans" in tables:
        orphans = tables["product_rates"].join(tables["rate_plans"].select("rate_plan_id"), "rate_plan_id",
                                               "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit("product_rates").alias("table_name"),
                             F.lit("foreign_key_rate_plan").alias("check_name"), "violations"))
    if "customers" in tables:
        c = tables["customers"]
        parts.append(_count_where("customers", "check_subscription_type", c,
                                  ~F.col("subscription_type").isin(*SUBSCRIPTION_TYPES)))
        parts.append(_count_where("customers", "check_status", c, ~F.col("status").isin(*CUSTOMER_STATUSES)))
    if "product_catalog" in tables:
        parts.append(_count_where("product_catalog", "check_service_type", tables["product_catalog"],
                                  ~F.col("service_type").isin(*SERVICES)))
    return reduce(DataFrame.unionByName, parts)


# -- the same rules with the rows that break them, one scan a table ------------

def _row_checks(name: str) -> dict[str, F.Column]:
    """Checks that a row fails by itself. A null primary key is one."""
    checks = {}
    if name in PRIMARY_KEYS:
        checks["primary_key"] = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in PRIMARY_KEYS[name]])
    if name == "customers":
        checks["check_subscription_type"] = ~F.col("subscription_type").isin(*SUBSCRIPTION_TYPES)
        checks["check_status"] = ~F.col("status").isin(*CUSTOMER_STATUSES)
    if name == "product_catalog":
        checks["check_service_type"] = ~F.col("service_type").isin(*SERVICES)
    return checks


def _rejected(name: str, check: str, rows: DataFrame, copies: F.Column) -> DataFrame:
    fields = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),
                       F.to_json(F.struct(*fields)).alias("record"), copies.cast("bigint").alias("copies"))


def quarantine(tables: dict[str, DataFrame], stage_path: str) -> DataFrame:
    """The records that break a rule: ``table_name, check_name, record, copies``.

    Each table is scanned once: its rows are written below ``stage_path`` with
    equal ones counted (map-side combined), and every check reads that. Of rows
    that share a primary key the first in column order stays, the others and its
    extra copies are rejected, so the copies of a check add up to its count in
    ``constraint_report``. A key with very many rows is joined, not grouped into
    one task.
    """
    parts, staged = [], {}
    for name, df in tables.items():
        path = f"{stage_path}/{name}"
        df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).write.mode("overwrite").parquet(path)
        staged[name] = rows = df.sparkSession.read.schema(
            T.StructType([*df.schema.fields, T.StructField("_copies", T.LongType())])).parquet(path)
        checks = _row_checks(name)
        if checks:
            failed = F.filter(F.array(*[F.when(bad, F.lit(check)) for check, bad in checks.items()]), lambda c: c.isNotNull())
            fields = [c for c in df.columns]
            parts.append(rows.select(F.explode(failed).alias("check_name"), F.to_json(F.struct(*fields)).alias("record"), "_copies")
                         .select(F.lit(name).alias("table_name"), "check_name", "record", F.col("_copies").alias("copies")))
        if name in PRIMARY_KEYS:
            keys = PRIMARY_KEYS[name]
            row = F.struct(*df.columns)
            shared = rows.groupBy(*keys).agg(F.sum("_copies").alias("_n"), F.min(row).alias("_kept")).where("_n > 1")
            extra = F.col("_copies") - row.eqNullSafe(F.col("_kept")).cast("bigint")
            parts.append(_rejected(name, "primary_key", rows.join(shared, keys).where(extra > 0), extra))     # null keys are above
    if "product_rates" in staged and "rate_plans" in staged:
        orphans = staged["product_rates"].join(staged["rate_plans"].select("rate_plan_id"), "rate_plan_id", "left_anti")
        parts.append(_rejected("product_rates", "foreign_key_rate_plan", orphans.select(*staged["product_rates"].columns), F.col("_copies")))
    return reduce(DataFrame.unionByName, parts)


def quarantine_report(rejected: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``constraint_report`` from the rejected records; checks without any count 0."""
    names = [(n, c) for n in tables for c in _row_checks(n)]
    if "product_rates" in tables and "rate_plans" in tables:
        names.append(("product_rates", "foreign_key_rate_plan"))
    zeros = rejected.sparkSession.createDataFrame([(n, c, None, 0) for n, c in names],
                                                  "table_name string, check_name string, record string, copies bigint")
    return rejected.unionByName(zeros).groupBy("table_name", "check_name").agg(F.sum("copies").alias("violations"))
