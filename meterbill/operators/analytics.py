"""Revenue, customer, usage and region metrics.

Pattern used throughout: aggregate the large fact table (invoices, rated
usage) to one row per customer (or customer-month) first -- partial
aggregation runs before the shuffle, so a customer holding a large share of
rows costs one row per map task -- then join the customer dimension and
regroup. Distinct-customer counts become plain row counts after that first
step, which avoids the expand-based distinct aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbill.functions.calendar import add_months, to_date, whole_years
from meterbill.functions.money import out_money, out_ratio
from meterbill.functions.regions import OTHER_REGION, region_of
from meterbill.schemas import RATED

MB = "decimal(24,6)"


def _since(col: str, start: dt.date):
    return F.col(col) >= F.lit(start)


# ---------------------------------------------------------------- invoices --
def revenue_monthly(invoices: DataFrame, as_of, months: int = 12) -> DataFrame:
    start = add_months(to_date(as_of), -months)
    return (invoices.where(_since("billing_period", start))
            .groupBy(F.trunc("billing_period", "MM").alias("month"))
            .agg(F.sum("total_final_cost").alias("_rev"), F.count(F.lit(1)).alias("total_invoices"))
            .select("month", out_money(F.col("_rev")).alias("total_revenue"), "total_invoices",
                    out_ratio(F.col("_rev"), F.col("total_invoices")).alias("avg_invoice"))
            .orderBy("month"))


def revenue_daily(invoices: DataFrame, as_of, days: int = 30) -> DataFrame:
    start = to_date(as_of) - dt.timedelta(days=days)
    return (invoices.where(_since("billing_period", start))
            .groupBy(F.to_date("billing_period").alias("date"))
            .agg(out_money(F.sum("total_final_cost")).alias("daily_revenue"),
                 F.count(F.lit(1)).alias("daily_invoices"))
            .orderBy("date"))


def customer_value(customers: DataFrame, invoices: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Spend and invoices of every active customer over the last ``months``; spend > 0."""
    start = add_months(to_date(as_of), -months)
    per_customer = (invoices.where(_since("billing_period", start))
                    .groupBy("customer_id")
                    .agg(F.sum("total_final_cost").alias("_spent"),
                         F.count("invoice_id").alias("total_invoices")))
    active = customers.where(F.col("status") == "active").select("customer_id")
    return (per_customer.join(active, "customer_id", "left_semi")
            .where(F.col("_spent") > 0)
            .select("customer_id", out_money(F.col("_spent")).alias("total_spent"), "total_invoices",
                    out_ratio(F.col("_spent"), F.col("total_invoices")).alias("avg_invoice")))


def top_customers(customers: DataFrame, invoices: DataFrame, as_of, n: int = 10,
                  months: int = 6) -> DataFrame:
    """The n customers of the largest spend, customer_id as the tie-break."""
    value = customer_value(customers, invoices, as_of, months)
    return value.orderBy(F.desc("total_spent"), F.asc("customer_id")).limit(n)


def billing_stats(invoices: DataFrame) -> DataFrame:
    per_customer = invoices.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_final_cost").alias("_rev"),
        F.max("billing_period").alias("_max"), F.min("billing_period").alias("_min"))
    return per_customer.agg(
        F.sum("_n").cast("bigint").alias("total_invoices"),
        F.count("customer_id").alias("unique_customers"),
        out_money(F.sum("_rev")).alias("total_revenue"),
        out_ratio(F.sum("_rev"), F.sum("_n")).alias("avg_invoice_amount"),
        F.max("_max").alias("latest_period"),
        F.min("_min").alias("earliest_period"))


def billing_monthly(invoices: DataFrame, n: int = 12) -> DataFrame:
    return (invoices.groupBy("billing_period")
            .agg(F.count(F.lit(1)).alias("invoice_count"), F.sum("total_final_cost").alias("_rev"))
            .select("billing_period", "invoice_count", out_money(F.col("_rev")).alias("monthly_revenue"),
                    out_ratio(F.col("_rev"), F.col("invoice_count")).alias("avg_amount"))
            .orderBy(F.desc("billing_period")).limit(n))


# --------------------------------------------------------------- customers --
def customer_metrics(customers: DataFrame, as_of) -> DataFrame:
    years = whole_years(F.lit(to_date(as_of)), F.col("activation_date"))
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count(F.when(F.col("status") == "active", 1)).alias("active_customers"),
        F.count(F.when(F.col("is_student"), 1)).alias("student_customers"),
        out_ratio(F.sum(years), F.count(years)).alias("avg_customer_age_years"))


def with_customer_rates(metrics: DataFrame) -> DataFrame:
    """active %, student %, tenure (0 when unknown)."""
    return metrics.select(
        "*",
        F.coalesce(out_ratio(F.col("active_customers"), F.col("total_customers"), 4, 100), F.lit(0.0))
         .alias("active_rate"),
        F.coalesce(out_ratio(F.col("student_customers"), F.col("total_customers"), 4, 100), F.lit(0.0))
         .alias("student_rate"),
        F.coalesce(F.col("avg_customer_age_years"), F.lit(0.0)).alias("avg_tenure_years"))


# ------------------------------------------------------------------ usage --
def _rated_since(rated: DataFrame, as_of, days: int) -> DataFrame:
    start = to_date(as_of) - dt.timedelta(days=days)
    return rated.where((F.col("rating_status") == RATED) & (F.col("timestamp") >= F.lit(start)))


def usage_by_service(rated: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (_rated_since(rated, as_of, days).groupBy("record_type")
            .agg(F.count(F.lit(1)).alias("total_records"), F.sum("final_cost").alias("_c"))
            .select("record_type", "total_records", out_money(F.col("_c"), 4).alias("total_cost"),
                    out_ratio(F.col("_c"), F.col("total_records"), 6).alias("avg_cost")))


def service_breakdown(rated: DataFrame, as_of, days: int = 30) -> DataFrame:
    rt = F.col("record_type")
    return (_rated_since(rated, as_of, days).groupBy("record_type")
            .agg(F.count(F.lit(1)).alias("call_count"), F.sum("final_cost").alias("_c"),
                 F.sum(F.when(rt == "voice", F.col("duration_sec")).otherwise(0)).cast("bigint")
                  .alias("total_duration"),
                 F.sum(F.when(rt == "data", F.col("data_volume_mb").cast(MB)).otherwise(0)).alias("_mb"))
            .select("record_type", "call_count", out_money(F.col("_c"), 4).alias("total_revenue"),
                    out_ratio(F.col("_c"), F.col("call_count"), 6).alias("avg_cost"),
                    "total_duration", F.round(F.col("_mb"), 4).cast("double").alias("total_data_mb")))


def processing_by_day(mediated: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Records per event date and status over the last ``days`` days.
    ``mediated`` is the de-duplicated frame with both statuses."""
    start = to_date(as_of) - dt.timedelta(days=days)
    ts = F.expr("try_cast(timestamp AS TIMESTAMP)") if dict(mediated.dtypes)["timestamp"] == "string" \
        else F.col("timestamp")
    return (mediated.where(ts >= F.lit(start))
            .groupBy(F.to_date(ts).alias("date"), F.col("status"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("date", "status"))


# ---------------------------------------------------------------- regions --
def _customer_city(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("region").alias("city"))


def region_revenue(invoices: DataFrame, customers: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Revenue by mapped region over the last ``months``."""
    start = add_months(to_date(as_of), -months)
    per_customer = (invoices.where(_since("billing_period", start)).groupBy("customer_id")
                    .agg(F.count("invoice_id").alias("_n"), F.sum("total_final_cost").alias("_rev"),
                         F.sum("total_base_cost").alias("_base"), F.sum("total_discount").alias("_disc"),
                         F.sum("tax_applied").alias("_tax")))
    j = per_customer.join(_customer_city(customers), "customer_id")
    return (j.groupBy(region_of(F.col("city")).alias("region"))
            .agg(F.count(F.lit(1)).alias("customer_count"), F.sum("_n").cast("bigint").alias("invoice_count"),
                 out_money(F.sum("_rev")).alias("total_revenue"),
                 out_money(F.sum("_base")).alias("total_base_cost"),
                 out_money(F.sum("_disc")).alias("total_discount"),
                 out_money(F.sum("_tax")).alias("total_tax"))
            .orderBy(F.desc("total_revenue"), "region"))


def with_region_ratios(region_stats: DataFrame) -> DataFrame:
    """revenue per customer, share of total revenue (%), discount rate (%).
    The total is a window over the already-aggregated region rows (a dozen)."""
    total = F.sum("total_revenue").over(Window.partitionBy())
    return region_stats.select(
        "*",
        out_ratio(F.col("total_revenue"), F.col("customer_count")).alias("avg_revenue_per_customer"),
        out_ratio(F.col("total_revenue"), total, 4, 100).alias("revenue_share"),
        out_ratio(F.col("total_discount"), F.col("total_base_cost"), 4, 100).alias("discount_rate"))


def region_monthly(invoices: DataFrame, customers: DataFrame, as_of, months: int = 12) -> DataFrame:
    start = add_months(to_date(as_of), -months)
    per_cm = (invoices.where(_since("billing_period", start))
              .groupBy("customer_id", F.trunc("billing_period", "MM").alias("month"))
              .agg(F.sum("total_final_cost").alias("_rev"), F.count("invoice_id").alias("_n")))
    j = per_cm.join(_customer_city(customers), "customer_id")
    return (j.groupBy("month", region_of(F.col("city")).alias("region"))
            .agg(out_money(F.sum("_rev")).alias("monthly_revenue"),
                 F.sum("_n").cast("bigint").alias("monthly_invoices"),
                 F.count(F.lit(1)).alias("active_customers")))


def top_region_series(monthly: DataFrame, n: int = 5) -> DataFrame:
    """Monthly rows of the n regions of the largest revenue over these months.
    Totals and ranks are windows over the monthly rows (months x regions)."""
    total = F.round(F.sum("monthly_revenue").over(Window.partitionBy("region")), 2)
    rank = F.dense_rank().over(Window.orderBy(F.desc("_total"), F.asc("region")))
    return (monthly.withColumn("_total", total).withColumn("_rank", rank)
            .where(F.col("_rank") <= n).drop("_total", "_rank"))


def region_performance(invoices: DataFrame, customers: DataFrame, rated: DataFrame, as_of,
                       months: int = 6, cities: int | None = None, parity: bool = False) -> DataFrame:
    """Revenue and per-service usage by region for the last ``months``.

    Usage is pre-aggregated per customer-month and joined to the invoice of
    that month, so each invoice is counted once. ``parity=True`` reproduces
    the original fan-out, where an invoice's amount is counted once per
    matching usage record, without materialising that fan-out.
    ``cities`` (optional) keeps the top cities by revenue before regrouping by
    region; by default every city counts.
    """
    start = add_months(to_date(as_of), -months)
    rt = F.col("record_type")
    usage = (rated.where((F.col("rating_status") == RATED) & (F.col("timestamp") >= F.lit(start)))
             .groupBy("customer_id", F.trunc(F.col("timestamp").cast("date"), "MM").alias("billing_period"))
             .agg(F.count(F.lit(1)).alias("_cdrs"),
                  F.sum(F.when(rt == "voice", F.col("final_cost"))).alias("_vrev"),
                  F.sum(F.when(rt == "sms", F.col("final_cost"))).alias("_srev"),
                  F.sum(F.when(rt == "data", F.col("final_cost"))).alias("_drev"),
                  F.sum(F.when(rt == "voice", F.col("duration_sec").cast("bigint"))).alias("_vsec"),
                  F.count(F.when(rt == "sms", 1)).alias("_sms"),
                  F.sum(F.when(rt == "data", F.col("data_volume_mb").cast(MB))).alias("_mb")))
    inv = invoices.where(_since("billing_period", start)).select(
        "customer_id", "billing_period", "total_final_cost")
    iu = inv.join(usage, ["customer_id", "billing_period"], "left")
    weight = F.greatest(F.coalesce(F.col("_cdrs"), F.lit(0)), F.lit(1)) if parity else F.lit(1)
    per_customer = iu.groupBy("customer_id").agg(
        F.sum(F.col("total_final_cost") * weight).alias("_rev"),
        F.sum(weight).alias("_rows"),
        F.max("billing_period").alias("_last"),
        *[F.sum(c).alias(c) for c in ["_vrev", "_srev", "_drev", "_vsec", "_sms", "_mb"]])
    city = (per_customer.join(_customer_city(customers), "customer_id")
            .groupBy("city")
            .agg(F.count(F.lit(1)).alias("total_customers"), F.sum("_rev").alias("_rev"),
                 F.sum("_rows").alias("_rows"), F.max("_last").alias("last_billing_period"),
                 *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                   for c in ["_vrev", "_srev", "_drev", "_vsec", "_sms", "_mb"]])
            .where(F.col("_rev") > 0))
    if cities is not None:
        city = city.orderBy(F.desc("_rev"), F.asc_nulls_first("city")).limit(cities)
    return (city.groupBy(region_of(F.col("city")).alias("region"))
            .agg(F.sum("total_customers").cast("bigint").alias("total_customers"),
                 out_money(F.sum("_rev")).alias("total_revenue"),
                 out_money(F.sum("_vrev"), 4).alias("voice_revenue"),
                 out_money(F.sum("_srev"), 4).alias("sms_revenue"),
                 out_money(F.sum("_drev"), 4).alias("data_revenue"),
                 out_ratio(F.sum("_vsec"), F.lit(60)).alias("voice_minutes"),
                 F.sum("_sms").cast("bigint").alias("sms_count"),
                 F.round(F.sum("_mb"), 4).cast("double").alias("data_mb"))
            .orderBy(F.desc("total_revenue"), "region"))


def with_performance_ratios(perf: DataFrame) -> DataFrame:
    r = F.col("total_revenue")
    return perf.select(
        "*",
        out_ratio(r, F.col("total_customers")).alias("arpu"),
        out_ratio(F.col("voice_revenue"), r, 4, 100).alias("voice_share"),
        out_ratio(F.col("sms_revenue"), r, 4, 100).alias("sms_share"),
        out_ratio(F.col("data_revenue"), r, 4, 100).alias("data_share"))


# ---------------------------------------------------------- invoice lists --
def enriched_invoices(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Invoices with customer attributes (orphans kept) and mapped region."""
    c = customers.select("customer_id", "customer_name", "rate_plan_id", "region", "is_student",
                         "activation_date")
    j = invoices.join(c, "customer_id", "left")
    return j.select(
        "invoice_id", "customer_id", "customer_name", "billing_period",
        *[F.col(m).cast("double").alias(m) for m in
          ("total_base_cost", "total_discount", "tax_applied", "total_final_cost")],
        "rate_plan_id", "region", "is_student", "activation_date",
        region_of(F.col("region")).alias("region_mapped"))


def invoices_with_customer(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    return invoices.join(customers.select("customer_id", "customer_name", "region", "status"), "customer_id")


def invoices_with_usage(invoices: DataFrame, rated: DataFrame) -> DataFrame:
    """Each invoice with the rated records of its customer and month (left
    join semantics; the status filter is applied to the usage side first).

    Written as inner join + invoices without usage (anti join against the
    distinct usage keys) instead of one LEFT join: AQE can split a skewed
    partition on either side of an inner join, but never on the
    null-supplying side of an outer join, so a customer-month holding a
    large share of the usage would otherwise land in a single task.
    """
    keys = ["customer_id", "billing_period"]
    r = (rated.where(F.col("rating_status") == RATED)
         .select("customer_id", F.trunc(F.col("timestamp").cast("date"), "MM").alias("billing_period"),
                 "record_hash", "record_type", "final_cost"))
    inv = invoices.select("invoice_id", "customer_id", "billing_period", "total_final_cost")
    matched = inv.join(r, keys, "inner")
    seen = r.select(*keys).distinct()
    alone = inv.join(seen, keys, "left_anti").select(
        *inv.columns, *[F.lit(None).cast(t).alias(c) for c, t in r.dtypes if c not in keys])
    return matched.unionByName(alone)


def sort_invoices(enriched: DataFrame) -> DataFrame:
    return enriched.orderBy(F.desc("billing_period"), F.asc("customer_id"), F.asc("invoice_id"))


def distinct_periods(enriched: DataFrame) -> DataFrame:
    return (enriched.select(F.date_format("billing_period", "yyyy-MM").alias("period")).distinct()
            .orderBy(F.desc("period")))


def distinct_regions(enriched: DataFrame) -> DataFrame:
    return (enriched.select("region_mapped").where(F.col("region_mapped").isNotNull()
                                                  & (F.col("region_mapped") != OTHER_REGION))
            .distinct().orderBy("region_mapped"))


def _filter_predicate(period: str | None, region: str | None):
    cond = F.lit(True)
    if period is not None:
        cond = cond & (F.date_format("billing_period", "yyyy-MM") == period)
    if region is not None:
        cond = cond & (F.col("region_mapped") == region)
    return cond


def filter_invoices(enriched: DataFrame, period: str | None = None, region: str | None = None) -> DataFrame:
    return enriched.where(_filter_predicate(period, region))


def filtered_billing(enriched: DataFrame, period: str | None = None, region: str | None = None) -> DataFrame:
    """KPIs of a (period, region) selection against the whole list in one
    pass: counts, revenue and share, means, distinct customers and share."""
    sel = _filter_predicate(period, region)
    amount = F.col("total_final_cost").cast("decimal(18,2)")
    per_customer = enriched.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(sel, 1)).alias("_nf"),
        F.sum(amount).alias("_rev"), F.sum(F.when(sel, amount)).alias("_revf"))
    t = per_customer.agg(
        F.sum("_nf").cast("bigint").alias("filtered_invoices"),
        F.sum("_n").cast("bigint").alias("all_invoices"),
        F.coalesce(F.sum("_revf"), F.lit(0)).alias("_revf"), F.sum("_rev").alias("_rev"),
        F.count(F.when(F.col("_nf") > 0, 1)).alias("filtered_customers"),
        F.count(F.lit(1)).alias("all_customers"))
    return t.select(
        "filtered_invoices", (F.col("filtered_invoices") - F.col("all_invoices")).alias("invoice_delta"),
        out_money(F.col("_revf")).alias("filtered_revenue"),
        out_ratio(F.col("_revf"), F.col("_rev"), 4, 100).alias("revenue_pct_of_total"),
        F.coalesce(out_ratio(F.col("_revf"), F.col("filtered_invoices"), 4), F.lit(0.0)).alias("filtered_mean"),
        out_ratio(F.col("_rev"), F.col("all_invoices"), 4).alias("overall_mean"),
        "filtered_customers",
        out_ratio(F.col("filtered_customers"), F.col("all_customers"), 4, 100).alias("customers_pct_of_total"))
