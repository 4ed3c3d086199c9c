"""Rating: normalized CDRs -> rated_cdr rows (priced and discounted)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.functions import rating as R
from meterbill.schemas import (DEFAULT_TARIFF, PRICE, RATED, RATED_CDR, RATED_COLUMNS,
                               STATUS_OK, UNMATCHED, TariffRules)

CDR_COLUMNS = ["record_hash", "record_type", "timestamp", "msisdn", "peer_id", "duration_sec",
               "data_volume_mb", "session_duration_sec", "cell_id", "technology", "status"]


def unprocessed(normalized: DataFrame, rated: DataFrame, arrived_since: dt.date | None = None) -> DataFrame:
    """Valid CDRs whose record_hash is not yet in rated_cdr.

    ``arrived_since`` (optional) bounds an incremental run by arrival: with an
    ``arrival_date`` column on the normalized table (the stream sinks write it),
    only what arrived from that day on is read, whatever its event time, and
    late CDRs and those without a timestamp are among them. A hash covers the
    timestamp, so a copy that was rated before lies in the same usage month: of
    a rated table stored by ``usage_month`` only the months of the new CDRs, and
    the rows without one (unmatched rows keep only hash and msisdn), are read.
    With an ``event_date`` partition column the months come from the partitions,
    and no column of the new CDRs is read for them. A ``RatedStore`` as
    ``rated`` is joined bucket by bucket, without shuffling it.
    """
    n = normalized.where(F.col("status") == STATUS_OK)
    if arrived_since is not None:
        if "arrival_date" in normalized.columns:
            since = F.col("arrival_date").isNull() | (F.col("arrival_date") >= F.lit(arrived_since))
            normalized, n = normalized.where(since), n.where(since)
        if "usage_month" in rated.columns:
            if "event_date" in normalized.columns:
                dates = normalized.select(F.trunc(F.col("event_date").cast("date"), "MM").alias("m"))
            else:
                dates = n.select(F.trunc(F.col("timestamp").cast("date"), "MM").alias("m"))
            months = [r[0] for r in dates.distinct().collect() if r[0] is not None]
            rated = rated.where(F.col("usage_month").isNull() | F.col("usage_month").isin(months))
    return n.join(rated.select("record_hash"), "record_hash", "left_anti")


def active_customers(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("status") == "active")


def with_customer(cdr: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on msisdn = customer_id with active customers. The
    customer table may be large, so no hint: AQE broadcasts it at run time
    when its measured size allows, and splits skewed msisdn partitions."""
    c = active_customers(customers).select(
        F.col("customer_id"), F.col("rate_plan_id"), F.col("activation_date"), F.col("is_student"))
    return cdr.join(c, cdr.msisdn == c.customer_id, "left")


def with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Left join on (plan, record_type) = (plan, service_type). The tariff
    grid (plans x services rows) is broadcast by the planner's own size
    check against autoBroadcastJoinThreshold, or by AQE from its measured
    size; a grid beyond the threshold falls back to a sort-merge join."""
    r = rates.select(F.col("rate_plan_id").alias("_plan"), F.col("service_type").alias("_service"),
                     F.col("unit_price"))
    return (df.join(r, (F.col("rate_plan_id") == F.col("_plan")) & (F.col("record_type") == F.col("_service")),
                    "left").drop("_plan", "_service"))


def _matched():
    return (F.col("customer_id").isNotNull() & F.col("unit_price").isNotNull()
            & R.is_priceable(F.col("record_type"), F.col("data_volume_mb"), F.col("unit_price")))


def split_matched(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched): matched needs a customer, a price and a volume
    that can be priced."""
    ok = _matched()
    return df.where(ok), df.where(~ok)


def price_matched(matched: DataFrame, as_of: dt.date,
                  rules: TariffRules = DEFAULT_TARIFF) -> DataFrame:
    ts = F.col("timestamp")
    hour, weekday = R.event_hour(ts), R.event_weekday(ts)
    base = R.base_cost(F.col("record_type"), F.col("duration_sec"), F.col("data_volume_mb"),
                       F.col("unit_price"), hour, weekday, F.col("peer_id"), rules)
    priced = matched.withColumn("base_cost", base)
    return priced.select(
        *CDR_COLUMNS, "customer_id", "rate_plan_id",
        F.col("unit_price").cast(PRICE).alias("unit_price"),
        "base_cost",
        R.discounted_cost(F.col("base_cost"), F.col("activation_date"), F.col("is_student"), as_of, rules)
         .alias("final_cost"),
        R.discount_tags(F.col("activation_date"), F.col("is_student"), as_of, rules).alias("discount_applied"),
        F.lit(RATED).alias("rating_status"),
    )


def unmatched_rows(unmatched: DataFrame) -> DataFrame:
    """Unmatched rows keep only record_hash and msisdn (typed NULLs)."""
    cols = []
    for f in RATED_CDR.fields:
        if f.name in ("record_hash", "msisdn"):
            cols.append(F.col(f.name))
        elif f.name == "rating_status":
            cols.append(F.lit(UNMATCHED).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return unmatched.select(*cols)


def combine_rated(rated: DataFrame, unmatched: DataFrame) -> DataFrame:
    return rated.select(*RATED_COLUMNS).unionByName(unmatched.select(*RATED_COLUMNS))


def rate(normalized: DataFrame, customers: DataFrame, rates: DataFrame, rated: DataFrame,
         as_of: dt.date, rules: TariffRules = DEFAULT_TARIFF, arrived_since: dt.date | None = None) -> DataFrame:
    """unprocessed -> customer join -> tariff join -> price -> discount.

    The matched / unmatched split and its union are expressed as one
    projection over the joined frame (``when(matched, value)``), so the
    joined input is read once instead of once per branch. The rows equal
    ``combine_rated(price_matched(m), unmatched_rows(u))`` of
    ``split_matched``.
    """
    joined = with_rate(with_customer(unprocessed(normalized, rated, arrived_since), customers), rates)
    ok = _matched()
    ts = F.col("timestamp")
    base = R.base_cost(F.col("record_type"), F.col("duration_sec"), F.col("data_volume_mb"),
                       F.col("unit_price"), R.event_hour(ts), R.event_weekday(ts), F.col("peer_id"), rules)
    priced = joined.withColumn("base_cost", F.when(ok, base)).withColumn("_ok", ok)
    m = F.col("_ok")
    computed = {
        "unit_price": F.col("unit_price").cast(PRICE),
        "base_cost": F.col("base_cost"),
        "final_cost": R.discounted_cost(F.col("base_cost"), F.col("activation_date"), F.col("is_student"),
                                        as_of, rules),
        "discount_applied": R.discount_tags(F.col("activation_date"), F.col("is_student"), as_of, rules),
    }
    cols = []
    for f in RATED_CDR.fields:
        if f.name in ("record_hash", "msisdn"):
            c = F.col(f.name)
        elif f.name == "rating_status":
            c = F.when(m, F.lit(RATED)).otherwise(F.lit(UNMATCHED))
        else:
            c = F.when(m, computed.get(f.name, F.col(f.name))).cast(f.dataType)
        cols.append(c.alias(f.name))
    return priced.select(*cols)


def rating_stats(rated: DataFrame) -> DataFrame:
    """processed, rated and unmatched counts in one aggregation."""
    s = F.col("rating_status")
    return rated.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count(F.when(s == RATED, 1)).alias("rated_count"),
        F.count(F.when(s == UNMATCHED, 1)).alias("unmatched_count"),
    )
