"""Monthly billing as one set-based plan.

Shuffle budget: rated usage is aggregated once per customer (partial
aggregation before the exchange) and joined to the active customers on
customer_id. Everything after that is arithmetic on the customer's single
row: the plan's free-unit allowances arrive through a broadcast lookup
(plans x services rows, size-checked by the planner), the per-service
lines are an array column, and the credit is a fold over it -- no second
aggregation and no second pass over the rated usage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions.calendar import in_period, month_diff, month_start
from meterbill.functions.money import dlit, out_money
from meterbill.operators.rating import active_customers
from meterbill.schemas import DEFAULT_BILLING, INVOICE_MONEY, RATED, SERVICES, BillingRules

AMOUNT = T.DecimalType(24, 6)
USAGE = T.DecimalType(24, 6)


def billing_period(as_of) -> dt.date:
    return month_start(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))


def billable_usage(rated: DataFrame, period: dt.date) -> DataFrame:
    """Rated (not unmatched) records of the month; a range predicate on the
    timestamp so file statistics prune, plus -- when the table is stored by
    usage month -- a predicate on that partition column so only the month's
    folder is listed and read (rows without a month have no timestamp)."""
    cond = (F.col("rating_status") == RATED) & in_period(F.col("timestamp"), period)
    if "usage_month" in rated.columns:
        cond = cond & (F.col("usage_month") == F.lit(period))
    return rated.where(cond)


def usage_totals(rated: DataFrame, period: dt.date) -> DataFrame:
    """Per customer: record count, sum(final_cost), and the usage measure of
    each service (voice seconds, sms count, data MB), in one aggregation."""
    rt = F.col("record_type")
    return (billable_usage(rated, period).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("usage_records"),
        F.sum("final_cost").cast(AMOUNT).alias("usage_cost"),
        F.coalesce(F.sum(F.when(rt == "voice", F.col("duration_sec").cast("bigint"))), F.lit(0))
         .cast(USAGE).alias("voice_usage"),
        F.count(F.when(rt == "sms", 1)).cast(USAGE).alias("sms_usage"),
        F.coalesce(F.sum(F.when(rt == "data", F.col("data_volume_mb").cast(USAGE))), F.lit(0))
         .cast(USAGE).alias("data_usage"),
    ))


def service_usage(rated: DataFrame, period: dt.date) -> DataFrame:
    """Long form: one row per (customer, service) with its usage measure."""
    rt = F.col("record_type")
    measure = (F.when(rt == "voice", F.col("duration_sec").cast(USAGE))
               .when(rt == "data", F.col("data_volume_mb").cast(USAGE))
               .otherwise(F.lit(1).cast(USAGE)))
    return (billable_usage(rated, period).where(rt.isin("voice", "sms", "data"))
            .groupBy("customer_id", "record_type")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.coalesce(F.sum(measure), F.lit(0)).cast(USAGE).alias("total_usage")))


def not_yet_invoiced(customers: DataFrame, invoices: DataFrame, period: dt.date) -> DataFrame:
    """Active customers without an invoice for ``period``."""
    done = invoices.where(F.col("billing_period") == F.lit(period)).select("customer_id")
    return active_customers(customers).join(done, "customer_id", "left_anti")


def with_usage(customers: DataFrame, usage: DataFrame) -> DataFrame:
    """Customers with at least one billable record in the month."""
    return customers.join(usage, "customer_id", "inner")


def plan_allowances(rates: DataFrame, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """One row per plan: list price and allowance (in usage units) of every
    service that has free units. Small by construction (plans x services);
    the planner broadcasts it when its size passes the broadcast threshold."""
    r = rates.where(F.col("free_units") > 0)
    svc = F.col("service_type")
    cols = []
    for s in SERVICES:
        scale = rules.free_unit_scale.get(s, 1)
        cols.append(F.max(F.when(svc == s, F.col("unit_price"))).cast(T.DecimalType(10, 4)).alias(f"_{s}_price"))
        cols.append(F.max(F.when(svc == s, F.col("free_units") * scale)).cast(USAGE).alias(f"_{s}_allowance"))
    return r.groupBy(F.col("rate_plan_id").alias("_plan")).agg(*cols)


def with_free_units(billable: DataFrame, rates: DataFrame, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """Adds ``free_lines`` (one struct per service with an allowance; a
    service with no use still gets a zero line) and ``credit`` to each
    billable customer row. Pure column arithmetic on the customer's row
    after a broadcast lookup of its plan: no shuffle, no regrouping."""
    a = plan_allowances(rates, rules)
    j = billable.join(a, F.col("rate_plan_id") == F.col("_plan"), "left").drop("_plan")
    lines = []
    for s in SERVICES:
        usage = F.coalesce(F.col(f"{s}_usage"), F.lit(0)).cast(USAGE)
        allowance = F.col(f"_{s}_allowance")
        used = F.least(usage, allowance)
        lines.append(F.struct(F.lit(s).alias("service"), usage.alias("total_usage"),
                              allowance.alias("free_allowance"), used.alias("free_used"),
                              (used * F.col(f"_{s}_price")).cast(AMOUNT).alias("credit")))
    present = F.filter(F.array(*lines), lambda x: x["free_allowance"].isNotNull())
    j = j.withColumn("free_lines", present)
    total = F.aggregate("free_lines", F.lit(0).cast(AMOUNT), lambda acc, x: (acc + x["credit"]).cast(AMOUNT))
    return j.withColumn("credit", total).drop(*[c for c in j.columns if c.startswith("_")])


def free_unit_lines(billable: DataFrame, rates: DataFrame,
                    rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """Long form: one row per (customer, service with an allowance)."""
    w = with_free_units(billable, rates, rules)
    return w.select("customer_id", F.inline("free_lines"))


def _loyal(as_of: dt.date, rules: BillingRules) -> Column:
    return F.coalesce(month_diff(F.lit(as_of), F.col("activation_date")) > rules.loyalty_months, F.lit(False))


def invoice_terms(customers: DataFrame, rates: DataFrame, rated: DataFrame, invoices: DataFrame,
                  as_of, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """Unrounded invoice terms per billable customer (one row each), with
    the free-unit lines as an array (at most one entry per service)."""
    as_of = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    period = billing_period(as_of)
    billable = with_usage(
        not_yet_invoiced(customers, invoices, period).select(
            "customer_id", "rate_plan_id", "activation_date", "is_student"),
        usage_totals(rated, period))
    t = with_free_units(billable, rates, rules)
    adjusted = F.greatest(F.lit(0).cast(AMOUNT), F.col("usage_cost") - F.col("credit")).cast(AMOUNT)
    t = t.withColumn("adjusted", adjusted)
    loyal, student = _loyal(as_of, rules), F.coalesce(F.col("is_student"), F.lit(False))
    adj = F.col("adjusted")
    t = t.withColumns({
        "is_loyal": loyal,
        "loyalty_discount": F.when(loyal, adj * dlit(rules.loyalty_discount)).otherwise(F.lit(0)),
        "student_discount": F.when(student, adj * dlit(rules.student_discount)).otherwise(F.lit(0)),
    })
    t = t.withColumn("discount", F.col("loyalty_discount") + F.col("student_discount"))
    t = t.withColumn("taxable", F.greatest(F.lit(0), adj - F.col("discount")))
    t = t.withColumn("tax", F.col("taxable") * dlit(rules.vat_rate))
    t = t.withColumn("total_due", F.col("taxable") + F.col("tax") + dlit(rules.regulatory_fee))
    return t.withColumn("billing_period", F.lit(period)).withColumn("student", student)


def generate_invoices(customers: DataFrame, rates: DataFrame, rated: DataFrame, invoices: DataFrame,
                      as_of, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """Rows for the invoices table. total_base_cost is the sum of the rated
    *final* costs (the usage was already discounted at rating time);
    total_discount = discounts + free-unit credit; each rounded to 2.

    invoice_id is a 64-bit hash of (customer, period): stable across
    re-runs and computed without a global ordering step. The key of the table
    is (customer_id, billing_period).
    """
    return invoices_of(invoice_terms(customers, rates, rated, invoices, as_of, rules))


def invoices_of(t: DataFrame) -> DataFrame:
    r2 = lambda c: F.round(c, 2).cast(INVOICE_MONEY)
    return t.select(
        F.xxhash64("customer_id", "billing_period").alias("invoice_id"),
        "customer_id", "billing_period",
        r2(F.col("usage_cost")).alias("total_base_cost"),
        r2(F.col("discount") + F.col("credit")).alias("total_discount"),
        r2(F.col("tax")).alias("tax_applied"),
        r2(F.col("total_due")).alias("total_final_cost"),
        F.current_timestamp().alias("generated_at"),
    )


def invoice_documents(customers: DataFrame, rates: DataFrame, rated: DataFrame, invoices: DataFrame,
                      as_of, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    """One nested document per customer-month; every amount is rounded from
    its unrounded term (so the parts need not add up after rounding)."""
    return documents_of(invoice_terms(customers, rates, rated, invoices, as_of, rules), rules)


def documents_of(t: DataFrame, rules: BillingRules = DEFAULT_BILLING) -> DataFrame:
    d = lambda c: F.round(c, 2).cast("double")
    line = lambda x: F.struct(
        x["total_usage"].cast("double").alias("total_usage"),
        x["free_allowance"].cast("double").alias("free_allowance"),
        x["free_used"].cast("double").alias("free_used"),
        F.round(x["credit"], 2).cast("double").alias("credit_applied"))
    details = F.map_from_entries(F.transform("free_lines", lambda x: F.struct(x["service"], line(x))))
    return t.select(
        "customer_id",
        F.date_format("billing_period", "yyyy-MM").alias("billing_period"),
        F.struct(
            F.col("customer_id"), F.col("rate_plan_id"),
            F.date_format("billing_period", "yyyy-MM").alias("billing_period"),
            F.struct(d(F.col("usage_cost")).alias("total_base_cost"),
                     d(F.col("credit")).alias("free_units_credit"),
                     d(F.col("adjusted")).alias("adjusted_usage_cost")).alias("usage_summary"),
            details.alias("free_units_details"),
            F.struct(d(F.col("loyalty_discount")).alias("loyalty_discount"),
                     d(F.col("student_discount")).alias("student_discount"),
                     d(F.col("discount")).alias("total_discounts")).alias("discounts"),
            F.struct(d(F.col("taxable")).alias("subtotal_after_discounts"),
                     d(F.col("tax")).alias("vat_20%"),
                     F.lit(float(rules.regulatory_fee)).alias("regulatory_fee"),
                     d(F.col("total_due")).alias("total_due")).alias("charges"),
        ).alias("document"),
    )


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Scalar view of the documents (one column per leaf outside the map)."""
    d = F.col("document")
    return docs.select(
        d["customer_id"].alias("customer_id"),
        d["rate_plan_id"].alias("rate_plan_id"),
        d["billing_period"].alias("billing_period"),
        d["usage_summary"]["total_base_cost"].alias("total_base_cost"),
        d["usage_summary"]["free_units_credit"].alias("free_units_credit"),
        d["usage_summary"]["adjusted_usage_cost"].alias("adjusted_usage_cost"),
        F.size(d["free_units_details"]).alias("free_unit_services"),
        d["discounts"]["loyalty_discount"].alias("loyalty_discount"),
        d["discounts"]["student_discount"].alias("student_discount"),
        d["discounts"]["total_discounts"].alias("total_discounts"),
        d["charges"]["subtotal_after_discounts"].alias("subtotal_after_discounts"),
        d["charges"]["vat_20%"].alias("vat"),
        d["charges"]["regulatory_fee"].alias("regulatory_fee"),
        d["charges"]["total_due"].alias("total_due"),
    )


def invoice_usage(rated: DataFrame, customer_id: str | None = None, period: dt.date | None = None) -> DataFrame:
    """Per customer-month and record type: count, seconds, MB, base, final,
    mean unit price. Without arguments it covers every customer-month;
    the filters (if given) are pushed to the scan."""
    r = rated.where(F.col("rating_status") == RATED)
    if customer_id is not None:
        r = r.where(F.col("customer_id") == customer_id)
    if period is not None:
        r = r.where(in_period(F.col("timestamp"), period))
    return (r.groupBy("customer_id", F.trunc(F.col("timestamp").cast("date"), "MM").alias("billing_period"),
                      "record_type")
            .agg(F.count(F.lit(1)).alias("usage_count"),
                 F.sum("duration_sec").cast("bigint").alias("total_duration_sec"),
                 F.round(F.sum(F.col("data_volume_mb").cast(USAGE)), 4).cast("double").alias("total_data_mb"),
                 out_money(F.sum("base_cost"), 4).alias("total_base_cost"),
                 out_money(F.sum("final_cost"), 4).alias("total_final_cost"),
                 F.round(F.avg("unit_price"), 4).cast("double").alias("avg_unit_price")))


def invoice_header(enriched: DataFrame, customer_id: str | None = None, period: dt.date | None = None) -> DataFrame:
    """Header of an invoice (amounts and customer), of one customer and month
    or of all."""
    h = enriched
    if customer_id is not None:
        h = h.where(F.col("customer_id") == customer_id)
    if period is not None:
        h = h.where(F.col("billing_period") == F.lit(period))
    return h.select("invoice_id", "customer_id", "customer_name", "billing_period", "total_base_cost",
                    "total_discount", "tax_applied", "total_final_cost", "rate_plan_id")


def invoice_detail(enriched: DataFrame, rated: DataFrame, customer_id: str | None = None,
                   period: dt.date | None = None) -> DataFrame:
    """Header and usage of each invoice: one row for each record type used
    (one with empty usage where there is none)."""
    usage = invoice_usage(rated, customer_id, period)
    return invoice_header(enriched, customer_id, period).join(
        usage.withColumnsRenamed({"total_base_cost": "usage_base_cost", "total_final_cost": "usage_final_cost"}),
        ["customer_id", "billing_period"], "left")


def invoice_lines(usage: DataFrame) -> DataFrame:
    """Printable usage lines: voice in whole minutes, data to 1 decimal MB,
    sms as a message count; amounts as 'x.xx MAD'; month as 'June 2025'."""
    rt = F.upper(F.col("record_type"))
    qty = (F.when(rt == "VOICE", F.format_string("%d minutes", F.floor(F.coalesce("total_duration_sec", F.lit(0)) / 60)
                                                 .cast("bigint")))
           .when(rt == "DATA", F.concat(_dec_text(F.col("total_data_mb"), 1), F.lit(" MB")))
           .otherwise(F.format_string("%d messages", F.col("usage_count"))))
    return usage.select(
        "customer_id", "record_type",
        F.date_format("billing_period", "MMMM yyyy").alias("period_label"),
        qty.alias("quantity"),
        F.concat(_dec_text(F.col("total_base_cost"), 2), F.lit(" MAD")).alias("base_amount"),
        F.concat(_dec_text(F.col("total_final_cost"), 2), F.lit(" MAD")).alias("final_amount"),
    )


def _dec_text(c: Column, digits: int) -> Column:
    """Half-up rounding in DECIMAL, rendered as text: the printed digits do
    not depend on how a formatter would round a binary double."""
    return F.round(c.cast(T.DecimalType(24, 4)), digits).cast("string")
