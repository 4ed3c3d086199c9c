"""Deterministic inputs derived from the driver's parquet tables.

Each function maps one driver table to one table of the billing data model
with plain projections (no sampling, no row caps), so the derived tables
grow with the source. The same rules are written in SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.schemas import MONEY, PRICE, PRODUCT_CATALOG, PRODUCT_RATES, RATE_PLANS
from meterbill.sources.tables import read_table

# Dates the fixtures are built around.
USAGE_AS_OF = dt.date(2024, 1, 31)      # events lie in 2024-01-01 .. 2024-01-30
HISTORY_AS_OF = dt.date(2001, 8, 1)     # orders lie in 1995-01-01 .. 2001-08-01

# ---- the tariff grid of the test model -----------------------------------
RATE_ROWS = [
    ("RP_BASIC", "voice", 0.01, 0),
    ("RP_BASIC", "sms", 0.05, 5),
    ("RP_BASIC", "data", 0.02, 0),
    ("RP_STUDENT", "voice", 0.008, 0),
    ("RP_STUDENT", "sms", 0.03, 5),
    ("RP_STUDENT", "data", 0.015, 0),
    ("RP_PREMIUM", "voice", 0.006, 10),
    ("RP_PREMIUM", "sms", 0.02, 10),
    ("RP_PREMIUM", "data", 0.01, 500),
]
PLAN_ROWS = [
    ("RP_BASIC", "Basic"),
    ("RP_STUDENT", "Student"),
    ("RP_PREMIUM", "Premium"),
    ("RP_NORATE", "No tariff"),
]
CATALOG_ROWS = [
    ("VOICE_MIN", "voice", "second", "per_unit"),
    ("SMS_MSG", "sms", "message", "per_unit"),
    ("DATA_MB", "data", "megabyte", "per_unit"),
]


# Declared schemas of the driver tables read here (no inference at planning time).
DRIVER_SCHEMAS = {
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
}


def driver_table(spark: SparkSession, root: str, name: str, **kw) -> DataFrame:
    return read_table(spark, root, name, schema=DRIVER_SCHEMAS.get(name), **kw)


def customer_id_of(custkey: Column) -> Column:
    return F.concat(F.lit("2126"), F.lpad(custkey.cast("string"), 8, "0"))


def customers(spark: SparkSession, root: str) -> DataFrame:
    c = driver_table(spark, root, "customer")
    key, seg = F.col("c_custkey"), F.col("c_mktsegment")
    nation = F.col("c_nationkey") % 14
    return c.select(
        customer_id_of(key).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit("postpaid").alias("subscription_type"),
        F.when(key % 17 == 4, "RP_NORATE").when(seg == "HOUSEHOLD", "RP_STUDENT")
         .when(seg == "MACHINERY", "RP_PREMIUM").otherwise("RP_BASIC").alias("rate_plan_id"),
        F.date_add(F.lit(dt.date(2018, 1, 15)), ((key * 37) % 2200).cast("int")).alias("activation_date"),
        F.when(key % 10 == 3, "suspended").when(key % 10 == 7, "terminated")
         .otherwise("active").alias("status"),
        F.when(nation == 0, "CASABLANCA").when(nation == 1, "RABAT").when(nation == 2, "Salé")
         .when(nation == 3, "marrakech").when(nation == 4, " TANGER ").when(nation == 5, "OUJDA")
         .when(nation == 6, "PARIS").when(nation == 7, "AGADIR").when(nation == 8, "FES").when(nation == 9, "KENITRA")
         .when(nation == 10, "Casablanca").when(nation == 11, "MEKNES").when(nation == 12, "TETOUAN").alias("region"),
        (seg == "HOUSEHOLD").alias("is_student"),
    )


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small literal table as a local relation, so the optimizer knows its
    exact size (a list-built frame is an RDD of unknown size, which no
    planner-side broadcast check could ever accept)."""
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame(rows, columns=schema.fieldNames()), schema=schema)


def product_rates(spark: SparkSession) -> DataFrame:
    return literal_table(spark, RATE_ROWS, PRODUCT_RATES)


def rate_plans(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PLAN_ROWS, RATE_PLANS)


def product_catalog(spark: SparkSession) -> DataFrame:
    return literal_table(spark, CATALOG_ROWS, PRODUCT_CATALOG)


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows of a test table over all task slots."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def usage_fields(spark: SparkSession, root: str) -> DataFrame:
    """One usage record per event, in normalized column form, with every
    50th event delivered twice (the duplicate class). ``offset`` is the
    arrival position (the event id)."""
    # the driver writes the table as one row group; a message log has a
    # partition for each reader
    e = _dealt(driver_table(spark, root, "events"), "event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    etype = F.col("event_type")
    uid = F.col("user_id").cast("string")
    value = F.col("value")
    copies = F.explode(F.when(F.col("event_id") % 50 == 0, F.array(F.lit(1), F.lit(2)))
                       .otherwise(F.array(F.lit(1))))
    e = e.select("*", k.alias("k"), copies.alias("_copy"))
    k = F.col("k")
    city = (F.when(k % 6 == 0, "CASABLANCA").when(k % 6 == 1, "RABAT").when(k % 6 == 2, "AGADIR")
            .when(k % 6 == 3, "MARRAKECH").when(k % 6 == 4, "TANGER").otherwise("OUJDA"))
    return e.select(
        F.col("event_id").alias("offset"),
        F.when(etype.isin("click", "signup"), "voice").when(etype == "view", "data")
         .when(etype == "purchase", "sms").otherwise("ping").alias("record_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(k % 25 == 0, F.lit(None).cast("string"))
         .when(k % 25 == 1, "999000000000").when(k % 25 == 2, "33612345678")
         .when(k % 25 == 3, F.concat(F.lit("2129"), F.lpad(uid, 8, "0")))
         .otherwise(F.concat(F.lit("2126"), F.lpad(uid, 8, "0"))).alias("msisdn"),
        F.when(etype == "view", F.lit(None).cast("string"))
         .when(k % 3 == 0, F.concat(F.lit("+33"), F.lpad(k.cast("string"), 9, "0")))
         .otherwise(F.concat(F.lit("2126"), F.lpad(k.cast("string"), 8, "0"))).alias("peer_id"),
        F.when(etype.isin("click", "signup"),
               F.when(k % 20 == 5, F.lit(-1)).otherwise(F.floor(value).cast("int") + 10))
         .alias("duration_sec"),
        F.when(etype == "view", value).alias("data_volume_mb"),
        F.when(etype == "view", F.floor(value).cast("int") * 10 + 30).alias("session_duration_sec"),
        F.concat(city, F.lit("_"), F.lpad((k % 50 + 1).cast("string"), 2, "0")).alias("cell_id"),
        F.when(k % 4 == 0, "2G").when(k % 4 == 1, "3G").when(k % 4 == 2, "4G")
         .otherwise("5G").alias("technology"),
    )


def raw_messages(spark: SparkSession, root: str) -> DataFrame:
    """The usage records as JSON messages (``offset``, ``value``), each in the
    field layout of its record type: voice (and unknown types) carry
    caller/callee, sms sender/receiver, data user_id."""
    u = usage_fields(spark, root)
    rt = F.col("record_type")
    voice_like = ~rt.isin("sms", "data")
    payload = F.struct(
        rt.alias("record_type"),
        F.col("timestamp"),
        F.when(voice_like, F.col("msisdn")).alias("caller_id"),
        F.when(voice_like, F.col("peer_id")).alias("callee_id"),
        F.when(rt == "sms", F.col("msisdn")).alias("sender_id"),
        F.when(rt == "sms", F.col("peer_id")).alias("receiver_id"),
        F.when(rt == "data", F.col("msisdn")).alias("user_id"),
        F.col("duration_sec"),
        F.col("session_duration_sec"),
        F.col("data_volume_mb"),
        F.col("cell_id"),
        F.col("technology"),
    )
    return u.select("offset", F.to_json(payload).alias("value"))


def invoice_history(spark: SparkSession, root: str) -> DataFrame:
    """One invoice per customer-month from ``orders``."""
    o = driver_table(spark, root, "orders")
    d42 = lambda v: F.lit(v).cast(T.DecimalType(4, 2))
    m = T.DecimalType(18, 2)
    g = (o.groupBy(F.col("o_custkey"), F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("billing_period"))
          .agg(F.min("o_orderkey").alias("invoice_id"),
               F.sum(F.col("o_totalprice").cast(m)).cast(m).alias("total_base_cost")))
    base = F.col("total_base_cost")
    disc = F.round(base * d42("0.05"), 2).cast(m)
    g = g.withColumn("total_discount", disc)
    tax = F.round((base - F.col("total_discount")) * d42("0.20"), 2).cast(m)
    g = g.withColumn("tax_applied", tax)
    final = F.round(base - F.col("total_discount") + F.col("tax_applied") + d42("1"), 2).cast(m)
    return g.select(
        F.col("invoice_id"),
        customer_id_of(F.col("o_custkey")).alias("customer_id"),
        "billing_period", "total_base_cost", "total_discount", "tax_applied",
        final.alias("total_final_cost"),
        F.add_months("billing_period", 1).cast("timestamp").alias("generated_at"),
    )


def rated_history(spark: SparkSession, root: str) -> DataFrame:
    """Rated usage from ``lineitem`` joined to ``orders`` (the large table)."""
    li = _dealt(driver_table(spark, root, "lineitem"), "l_orderkey")
    o = driver_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    rt = (F.when(F.col("l_returnflag") == "A", "voice").when(F.col("l_returnflag") == "R", "data")
          .otherwise("sms"))
    base = (F.col("l_extendedprice").cast(T.DecimalType(12, 2))
            * F.lit("0.001").cast(T.DecimalType(4, 3)))
    final = base * (F.lit(1).cast(T.DecimalType(4, 2)) - F.col("l_discount").cast(T.DecimalType(4, 2)))
    cid = customer_id_of(F.col("o_custkey"))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("record_hash"),
        rt.alias("record_type"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        cid.alias("msisdn"),
        F.lit(None).cast("string").alias("peer_id"),
        F.when(rt == "voice", F.col("l_quantity").cast("int") * 6).alias("duration_sec"),
        F.when(rt == "data", F.col("l_quantity")).alias("data_volume_mb"),
        F.lit(None).cast("int").alias("session_duration_sec"),
        F.lit(None).cast("string").alias("cell_id"),
        F.lit(None).cast("string").alias("technology"),
        F.lit("ok").alias("status"),
        cid.alias("customer_id"),
        F.lit(None).cast("string").alias("rate_plan_id"),
        F.col("l_tax").cast(PRICE).alias("unit_price"),
        base.cast(MONEY).alias("base_cost"),
        final.cast(MONEY).alias("final_cost"),
        F.lit(None).cast("string").alias("discount_applied"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), "unmatched")
         .otherwise("rated").alias("rating_status"),
    )
