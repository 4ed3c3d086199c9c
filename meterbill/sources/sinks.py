"""Sinks: table appends, invoice documents, exports, CDR writers, SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.schemas import EXPORT_RENAMES
from meterbill.sources.tables import path_exists


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
           options: dict[str, str] | None = None) -> None:
    """Append a batch to a table (parquet folder, or JDBC with ``fmt='jdbc'``
    and url/dbtable options)."""
    w = df.write.mode("append").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save() if fmt == "jdbc" else w.save(path)


USAGE_MONTH = "usage_month"


def write_rated(rated: DataFrame, path: str, mode: str = "append") -> None:
    """Append rated rows to the rated table, one folder per usage month
    (unmatched rows, which have no timestamp, land in the default folder).
    Billing one month then lists and reads a single folder."""
    # rebalanced by month: no file per task and month, and a big month is split
    (rated.withColumn(USAGE_MONTH, F.trunc(F.col("timestamp").cast("date"), "MM")).hint("rebalance", USAGE_MONTH)
     .write.mode(mode).partitionBy(USAGE_MONTH).parquet(path))


def write_invoices(invoices: DataFrame, path: str, mode: str = "append") -> None:
    """Append invoice rows, one folder per billing period."""
    invoices.write.mode(mode).partitionBy("billing_period").parquet(path)


def write_invoice_documents(docs: DataFrame, path: str, periods: list[str] | None = None) -> None:
    """One JSON document per line, folders by billing period; written by
    the executors in parallel (no driver-side files). Documents are added,
    never replaced: one per customer and period, so a second run of a month
    adds those of customers that have none yet. ``periods`` (as the documents
    write them) names those of ``docs``; then only their folders are read, and
    documents of others are left out."""
    spark = docs.sparkSession
    rows = docs.select(F.col("document.customer_id").alias("customer_id"),
                       F.col("document.billing_period").alias("billing_period"), F.to_json("document").alias("value"))
    if path_exists(spark, path):
        done = spark.read.schema("value string, billing_period string").text(path)
        if periods is not None:                  # folders of other periods are not read
            rows, done = (x.where(F.col("billing_period").isin(list(periods))) for x in (rows, done))
        done = done.select("billing_period", F.get_json_object("value", "$.customer_id").alias("customer_id"))
        rows = rows.join(done, ["customer_id", "billing_period"], "left_anti")
    rows.select("billing_period", "value").write.mode("append").partitionBy("billing_period").text(path)


# values are written as they are (the CSV writer trims spaces by default)
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_frame(enriched: DataFrame) -> DataFrame:
    """The invoice list under its export column names. The raw city column
    is exported as ``city`` because ``Region`` (the mapped region) would
    otherwise clash with ``region`` in Spark's case-insensitive resolution."""
    renames = {k: v for k, v in EXPORT_RENAMES.items() if k in enriched.columns}
    if "region" in enriched.columns and "Region" in renames.values():
        # renames apply in order and match names case-insensitively, so the
        # raw column must move out of the way first
        renames = {"region": "city", **renames}
    return enriched.withColumnsRenamed(renames)


def export_invoices(enriched: DataFrame, path: str, fmt: str = "csv") -> None:
    """Invoice list with the export column names; 'excel' is written as CSV."""
    out = export_frame(enriched)
    if fmt in ("csv", "excel"):
        (out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path))
    elif fmt == "json":
        out.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")


def write_cdr(messages: DataFrame, mode: str, path: str | None = None, topic: str | None = None,
              **options: str) -> None:
    """Usage records as JSON lines, CSV, or messages to a topic.
    ``messages`` holds the raw record columns."""
    if mode == "json":
        messages.write.mode("overwrite").json(path)
    elif mode == "csv":
        messages.write.mode("overwrite").option("header", True).csv(path)
    elif mode == "kafka":
        w = messages.select(F.to_json(F.struct(*messages.columns)).alias("value")).write.format("kafka")
        for k, v in options.items():
            w = w.option(k.replace("__", "."), v)
        w.option("topic", topic).save()
    else:
        raise ValueError(f"unknown CDR output mode {mode!r}")


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound named parameters (``:name``) and frames referenced as
    ``{name}`` -- no global temp views, no string interpolation of values."""
    return spark.sql(query, args=args or {}, **frames)
