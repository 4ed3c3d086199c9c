"""Stored sums by customer and month, kept up to date month by month.

Dashboard figures sum invoices and usage over months. Their sums merge, so the
sums of a customer and month are stored once, a folder a month, and a figure
reads a few rows a customer instead of every record. When rows are added, only
the months they touch are read again and replaced (dynamic partition
overwrite): a refresh that is repeated, or that follows a failed one, gives the
same table. Sources are append-only: a month that loses all its rows keeps its
last sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions.calendar import add_months, to_date
from meterbill.functions.money import out_money, out_ratio
from meterbill.functions.regions import region_of
from meterbill.schemas import RATED
from meterbill.sources.sinks import USAGE_MONTH
from meterbill.sources.tables import read_or_empty

PERIOD = "billing_period"
_SUM = T.DecimalType(38, 6)
_TOTALS = ["revenue", "base", "discount", "tax"]
_USAGE = ["voice_revenue", "sms_revenue", "data_revenue", "voice_sec", "sms", "mb"]

INVOICE_SUMS = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("invoices", T.LongType()),
                             T.StructField("rows", T.LongType()),
                             *[T.StructField(c, _SUM) for c in _TOTALS], T.StructField(PERIOD, T.DateType())])
USAGE_SUMS = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("records", T.LongType()),
                           *[T.StructField(c, T.LongType() if c in ("voice_sec", "sms") else _SUM) for c in _USAGE],
                           T.StructField(USAGE_MONTH, T.DateType())])


def invoice_sums(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("customer_id", PERIOD).agg(
        F.count("invoice_id").alias("invoices"), F.count("*").alias("rows"),
        *[F.sum(c).cast(_SUM).alias(n) for c, n in (("total_final_cost", "revenue"), ("total_base_cost", "base"),
                                                    ("total_discount", "discount"), ("tax_applied", "tax"))])


def usage_sums(rated: DataFrame) -> DataFrame:
    rt = F.col("record_type")
    month = F.trunc(F.col("timestamp").cast("date"), "MM") if USAGE_MONTH not in rated.columns else F.col(USAGE_MONTH)
    of = lambda kind, c: F.sum(F.when(rt == kind, c))
    return (rated.where(F.col("rating_status") == RATED).groupBy("customer_id", month.alias(USAGE_MONTH)).agg(
        F.count("*").alias("records"), of("voice", F.col("final_cost")).cast(_SUM).alias("voice_revenue"),
        of("sms", F.col("final_cost")).cast(_SUM).alias("sms_revenue"), of("data", F.col("final_cost")).cast(_SUM).alias("data_revenue"),
        of("voice", F.col("duration_sec").cast("bigint")).alias("voice_sec"), F.count(F.when(rt == "sms", 1)).alias("sms"),
        of("data", F.col("data_volume_mb").cast("decimal(24,6)")).cast(_SUM).alias("mb")))


class Rollup:
    """A table of sums at ``path``, a folder for each value of ``partition``."""

    def __init__(self, spark: SparkSession, path: str, partition: str, schema: T.StructType,
                 build: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.partition, self.schema, self.build = spark, path, partition, schema, build

    def refresh(self, source: DataFrame, values: Sequence) -> None:
        """Build the sums of these partition values anew from ``source``. The
        predicate prunes a source that is stored by the same column."""
        self._write(self.build(source.where(F.col(self.partition).isin(list(values)))))

    def build_all(self, source: DataFrame) -> None:
        self._write(self.build(source))

    def _write(self, sums: DataFrame) -> None:
        (sums.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).hint("rebalance", self.partition)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path))

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)


def invoice_rollup(spark: SparkSession, path: str) -> Rollup:
    return Rollup(spark, path, PERIOD, INVOICE_SUMS, invoice_sums)


def usage_rollup(spark: SparkSession, path: str) -> Rollup:
    return Rollup(spark, path, USAGE_MONTH, USAGE_SUMS, usage_sums)


# -- figures from the stored sums (equal to those of ``analytics``) -----------

def _since(sums: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    return sums.where(F.col(PERIOD) >= F.lit(add_months(to_date(as_of), -months)))


def revenue_monthly(sums: DataFrame, as_of, months: int = 12) -> DataFrame:
    total = _since(sums, as_of, months).groupBy(F.trunc(PERIOD, "MM").alias("month")).agg(
        F.sum("revenue").alias("r"), F.sum("rows").alias("total_invoices"))
    return total.select("month", out_money(F.col("r")).alias("total_revenue"), "total_invoices",
                        out_ratio(F.col("r"), F.col("total_invoices")).alias("avg_invoice")).orderBy("month")


def _by_customer(sums: DataFrame, columns: Sequence[str]) -> DataFrame:
    return sums.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in columns])


def _city(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("region").alias("city"))


def region_revenue(sums: DataFrame, customers: DataFrame, as_of, months: int = 12) -> DataFrame:
    per = _by_customer(_since(sums, as_of, months), ["invoices", *_TOTALS]).join(_city(customers), "customer_id")
    return per.groupBy(region_of(F.col("city")).alias("region")).agg(
        F.count("*").alias("customer_count"), F.sum("invoices").cast("bigint").alias("invoice_count"),
        out_money(F.sum("revenue")).alias("total_revenue"), out_money(F.sum("base")).alias("total_base_cost"),
        out_money(F.sum("discount")).alias("total_discount"), out_money(F.sum("tax")).alias("total_tax"),
    ).orderBy(F.desc("total_revenue"), "region")


def region_performance(sums: DataFrame, usage: DataFrame, customers: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Revenue and usage by region; a customer-month's usage counts once for each
    of its invoices, as in ``analytics``."""
    billed = _since(sums, as_of, months).join(usage.withColumnRenamed(USAGE_MONTH, PERIOD), ["customer_id", PERIOD], "left")
    per = billed.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"), *[F.sum(F.col(c) * F.col("rows")).alias(c) for c in _USAGE])
    cities = per.join(_city(customers), "customer_id").groupBy("city").agg(
        F.count("*").alias("total_customers"), F.sum("revenue").alias("revenue"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _USAGE]).where(F.col("revenue") > 0)
    return cities.groupBy(region_of(F.col("city")).alias("region")).agg(
        F.sum("total_customers").cast("bigint").alias("total_customers"), out_money(F.sum("revenue")).alias("total_revenue"),
        *[out_money(F.sum(c), 4).alias(c) for c in ("voice_revenue", "sms_revenue", "data_revenue")],
        out_ratio(F.sum("voice_sec"), F.lit(60)).alias("voice_minutes"), F.sum("sms").cast("bigint").alias("sms_count"),
        F.round(F.sum("mb"), 4).cast("double").alias("data_mb")).orderBy(F.desc("total_revenue"), "region")
