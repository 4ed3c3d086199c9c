"""Registered queries: one per operator id of the inventory.

Each entry is ``f(spark, sf_dir) -> DataFrame`` over the driver's tables
(through the fixture derivations), so the work grows with the tables.
Money leaves the engine as DOUBLE rounded from exact decimals; the oracle
SQL twins live in ``meterbill.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.functions import rating as R
from meterbill.functions import sql as SQ
from meterbill.functions.regions import region_of
from meterbill.operators import analytics as A
from meterbill.operators import billing as B
from meterbill.operators import mediation as M
from meterbill.operators import pages as PG
from meterbill.operators import quality as Q
from meterbill.operators import rating as RT
from meterbill.operators import rollups as RU
from meterbill.operators import segments as S
from meterbill.operators import windows as W
from meterbill.plans.jobs import run_billing, run_mediation, run_pipeline
from meterbill.schemas import NORMALIZED_CDR, RATED_CDR, RAW_CDR
from meterbill.session import scratch_path
from meterbill.sources import commits as CM
from meterbill.sources import fixtures as FX
from meterbill.sources import sinks as SK
from meterbill.sources.cdr import decode_cdr, read_cdr_stream
from meterbill.sources.rated_store import RatedStore
from meterbill.sources.result_cache import ResultCache
from meterbill.sources.tables import empty_frame, path_exists, read_or_empty, read_table, shared_cache, table_path
from meterbill.streaming import anomalies as SN
from meterbill.streaming import mediation as SM
from meterbill.streaming import winners as SW

USAGE_AS_OF = FX.USAGE_AS_OF
HISTORY_AS_OF = FX.HISTORY_AS_OF
USAGE_PERIOD = dt.date(2024, 1, 1)
PRIOR_CUTOFF = dt.date(2024, 1, 16)     # the earlier rating run covered events before this day
PERIOD_LABEL = USAGE_PERIOD.strftime("%Y-%m")
HISTORY_PERIOD = dt.date(2001, 7, 1)
FILTER_PERIOD, FILTER_REGION = "2001-07", "Casablanca-Settat"
RAW_FIELDS = [f.name for f in RAW_CDR.fields]


_PRIOR: dict[tuple[str, str], str] = {}


class Inputs:
    """Lazily derived input frames for one (session, data folder)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @cached_property
    def customers(self) -> DataFrame:
        return FX.customers(self.spark, self.root)

    @cached_property
    def rates(self) -> DataFrame:
        return FX.product_rates(self.spark)

    @cached_property
    def raw(self) -> DataFrame:
        return FX.raw_messages(self.spark, self.root)

    @cached_property
    def decoded(self) -> DataFrame:
        return decode_cdr(self.raw, keep=("offset",))

    @cached_property
    def mediated_all(self) -> DataFrame:
        return M.mediate_all(self.decoded)

    @cached_property
    def normalized(self) -> DataFrame:
        return M.to_normalized(M.keep_valid(self.mediated_all))

    @cached_property
    def no_rated(self) -> DataFrame:
        return empty_frame(self.spark, RATED_CDR)

    @cached_property
    def joined(self) -> DataFrame:
        return RT.with_rate(RT.with_customer(RT.unprocessed(self.normalized, self.no_rated), self.customers),
                            self.rates)

    @cached_property
    def rated(self) -> DataFrame:
        return RT.rate(self.normalized, self.customers, self.rates, self.no_rated, USAGE_AS_OF)

    @cached_property
    def invoices_hist(self) -> DataFrame:
        return FX.invoice_history(self.spark, self.root)

    @cached_property
    def rated_hist(self) -> DataFrame:
        return FX.rated_history(self.spark, self.root)

    @cached_property
    def enriched(self) -> DataFrame:
        return A.enriched_invoices(self.invoices_hist, self.customers)

    @cached_property
    def terms(self) -> DataFrame:
        return B.invoice_terms(self.customers, self.rates, self.rated, self.invoices_hist, USAGE_AS_OF)

    @cached_property
    def monthly(self) -> DataFrame:
        return A.revenue_monthly(self.invoices_hist, HISTORY_AS_OF)

    @cached_property
    def metrics(self) -> DataFrame:
        return A.customer_metrics(self.customers, USAGE_AS_OF)

    @cached_property
    def region_stats(self) -> DataFrame:
        return A.region_revenue(self.invoices_hist, self.customers, HISTORY_AS_OF)

    @cached_property
    def prior_rated(self) -> DataFrame:
        """What an earlier run rated and stored: events before PRIOR_CUTOFF. The
        table is written when a session first asks for it."""
        at = (self.spark.sparkContext.applicationId, self.root)
        if at not in _PRIOR or not path_exists(self.spark, _PRIOR[at]):
            path = scratch_path(self.spark, "rated-table")
            SK.write_rated(RT.rate(self.normalized.where(F.col("timestamp") < F.lit(PRIOR_CUTOFF)), self.customers,
                                   self.rates, self.no_rated, USAGE_AS_OF), path, mode="overwrite")
            _PRIOR[at] = path
        return self.spark.read.schema(T.StructType([*RATED_CDR.fields, T.StructField(SK.USAGE_MONTH, T.DateType())])).parquet(_PRIOR[at])

    @cached_property
    def new_rated(self) -> DataFrame:
        return RT.rate(self.normalized, self.customers, self.rates, self.prior_rated, USAGE_AS_OF)

    @cached_property
    def population(self) -> DataFrame:
        return A.customer_value(self.customers, self.invoices_hist, HISTORY_AS_OF)

    @cached_property
    def top20(self) -> DataFrame:
        return A.top_customers(self.customers, self.invoices_hist, HISTORY_AS_OF, n=20)

    @cached_property
    def rfm(self) -> DataFrame:
        return S.rfm_segments(S.rfm_scores(self.population))


_RESULTS: dict[str, ResultCache] = {}


def _result_cache(spark: SparkSession) -> ResultCache:
    return _RESULTS.setdefault(spark.sparkContext.applicationId, ResultCache())


REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {}


def q(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def dbl(c: str, digits: int = 6):
    return F.round(F.col(c), digits).cast("double").alias(c)


def rated_out(df: DataFrame) -> DataFrame:
    return df.select(*[dbl(c) if c in ("unit_price", "base_cost", "final_cost") else F.col(c)
                       for c in df.columns])


def decoded_fields(df: DataFrame) -> DataFrame:
    return df.select("offset", *RAW_FIELDS)


def _stream_raw_folder(i: Inputs) -> str:
    """The raw messages as newline-delimited JSON files (the message log a
    stream replays), written by the executors under the checkpoint root.
    Messages are dealt by their hash, so no file is in time order."""
    path = scratch_path(i.spark, "cdr-log")
    files = max(4, i.spark.sparkContext.defaultParallelism // 2)
    i.raw.select("value").repartition(files, F.xxhash64("value")).write.mode("overwrite").text(path)
    return path


def _run_stream(i: Inputs, transform, trigger: str | None = None, graceful: bool = False,
                log: str | None = None, out: str | None = None, ckpt: str | None = None,
                sink: str = "files", files_per_batch: int = 1) -> DataFrame:
    log = log or _stream_raw_folder(i)
    out = out or scratch_path(i.spark, "stream-out")
    ckpt = ckpt or scratch_path(i.spark, "stream-ckpt")
    stream = read_cdr_stream(i.spark, "text", log, maxFilesPerTrigger=str(files_per_batch))
    query = SM.start_mediation(transform(stream), out, ckpt, trigger=trigger or SM.DEFAULT_TRIGGER,
                               available_now=trigger is None, sink=sink)
    if trigger is None:
        query.awaitTermination()
    else:
        query.processAllAvailable()
        SM.stop(query) if graceful else query.stop()
    schema = transform(stream).schema            # an output without rows has none
    columns = [f.name for f in schema.fields]
    return i.spark.read.schema(schema).parquet(out).select(*columns)


# ------------------------------------------------------------ 2.1 sources --
@q("src_cdr_stream")
def _(i):
    return _run_stream(i, lambda s: decode_cdr(s)).select(*RAW_FIELDS)


@q("src_decode_json")
def _(i):
    return decoded_fields(i.decoded)


@q("src_table")
def _(i):
    return i.customers


@q("src_table_where")
def _(i):
    o = read_table(i.spark, i.root, "orders", where=F.col("o_orderdate") >= F.lit(dt.datetime(2001, 2, 1)).cast("timestamp_ntz"))
    return o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@q("src_or_empty")
def _(i):
    present = read_or_empty(i.spark, table_path(i.root, "customer"), i.spark.read.parquet(
        table_path(i.root, "customer")).schema)
    absent = read_or_empty(i.spark, scratch_path(i.spark, "missing-table"), present.schema)
    return present.unionByName(absent)


@q("sink_append")
def _(i):
    path = scratch_path(i.spark, "normalized")
    SK.append(i.normalized, path)
    return i.spark.read.parquet(path)


@q("sink_append_once")
def _(i):
    """Two runs, each started twice, the first attempt of one killed before its
    commit: every record is there once."""
    path, odd = scratch_path(i.spark, "normalized"), F.pmod(F.xxhash64("record_hash"), F.lit(2)) == 1
    # mediated once, for all attempts; a filter on the hash of a frame that is not
    # stored would decode every message again in the scan, a few times a row
    stage = scratch_path(i.spark, "normalized-stage")
    i.normalized.write.parquet(stage)
    normalized = i.spark.read.schema(NORMALIZED_CDR).parquet(stage)
    normalized.where(odd).write.parquet(f"{path}/run=odd")             # written, never committed
    for run, part in (("odd", odd), ("even", ~odd), ("odd", odd), ("even", ~odd)):
        CM.append_run(normalized.where(part), path, run)
    return CM.read_committed(i.spark, path, NORMALIZED_CDR).drop(CM.RUN)


@q("sink_foreach_batch")
def _(i):
    return _run_stream(i, run_mediation, sink="foreach_batch")


@q("sink_invoice_json")
def _(i):
    path = scratch_path(i.spark, "invoice-docs")
    docs = B.invoice_documents(i.customers, i.rates, i.rated, i.invoices_hist, USAGE_AS_OF)
    SK.write_invoice_documents(docs, path, [PERIOD_LABEL])
    SK.write_invoice_documents(docs, path, [PERIOD_LABEL])      # a second run adds nothing
    back = i.spark.read.text(path)
    doc_type = docs.schema["document"].dataType
    return B.flatten_documents(back.select(F.from_json("value", doc_type).alias("document")))


@q("sink_export")
def _(i):
    path = scratch_path(i.spark, "export")
    SK.export_invoices(i.enriched, path, "csv")
    schema = SK.export_frame(i.enriched).schema
    return i.spark.read.schema(schema).options(**SK.CSV_OPTIONS).csv(path)


@q("sink_export_json")
def _(i):
    path = scratch_path(i.spark, "export")
    SK.export_invoices(i.enriched, path, "json")
    return i.spark.read.schema(SK.export_frame(i.enriched).schema).json(path)


@q("sink_cdr_csv")
def _(i):
    path = scratch_path(i.spark, "cdr-csv")
    SK.write_cdr(decoded_fields(i.decoded), "csv", path)
    return i.spark.read.schema(decoded_fields(i.decoded).schema).option("header", True).csv(path)


@q("sink_cdr_records")
def _(i):
    path = scratch_path(i.spark, "cdr-json")
    SK.write_cdr(decoded_fields(i.decoded), "json", path)
    return i.spark.read.schema(decoded_fields(i.decoded).schema).json(path)


@q("sql_param")
def _(i):
    return SK.run_sql(
        i.spark,
        "SELECT customer_id, count(*) AS invoices, CAST(sum(total_final_cost) AS DOUBLE) AS revenue "
        "FROM {inv} WHERE billing_period >= :start GROUP BY customer_id",
        args={"start": dt.date(2001, 2, 1)}, inv=i.invoices_hist)


@q("cache_table")
def _(i):
    """Active customers held on the executors for 300 s (dashboard cache life)."""
    return shared_cache(i.spark, f"active customers of {i.root}", lambda: RT.active_customers(i.customers),
                        ttl_s=300).get()


@q("cache_result")
def _(i):
    """A query kept by its meaning: the same plan, built anew, is a hit."""
    def active():
        return RT.active_customers(FX.customers(i.spark, i.root))
    cache = _result_cache(i.spark)
    first = cache.get(active())
    again = cache.get(active())
    assert again is first or cache.hits > 0
    return again


# --------------------------------------------------------- 2.2 mediation --
@q("med_msisdn")
def _(i):
    return M.normalize_parties(i.decoded).select("offset", "record_type", "msisdn")


@q("med_peer")
def _(i):
    return M.normalize_parties(i.decoded).select("offset", "record_type", "peer_id")


@q("med_status")
def _(i):
    return M.validate(M.normalize_parties(i.decoded)).select("offset", "record_type", "msisdn", "status")


@q("med_hash")
def _(i):
    return M.with_record_hash(M.normalize_parties(i.decoded)).select("offset", "record_type", "record_hash")


MED_COLS = ["record_hash", "status", "record_type", "timestamp", "msisdn", "peer_id", "duration_sec",
            "data_volume_mb", "session_duration_sec", "cell_id", "technology", "offset"]


@q("med_dedup")
def _(i):
    return i.mediated_all.select(*MED_COLS)


@q("med_clean")
def _(i):
    return M.keep_valid(i.mediated_all).select(*MED_COLS)


@q("med_project")
def _(i):
    hashed = M.with_record_hash(M.validate(M.normalize_parties(i.decoded)))
    return M.to_normalized(M.keep_valid(hashed))


@q("med_pipeline")
def _(i):
    return M.mediate(i.decoded)


@q("med_reject_profile")
def _(i):
    return Q.reject_profile(i.decoded)


@q("med_anomaly_profile")
def _(i):
    return Q.anomaly_profile(i.decoded)


@q("med_anomaly_profile_stream")
def _(i):
    """The same profile from micro-batches, each a range of offsets."""
    log, out = scratch_path(i.spark, "cdr-log"), scratch_path(i.spark, "profile")
    rows = i.raw.select(F.col("offset").cast("long").alias("offset"), "value")
    rows.repartitionByRange(4, "offset").write.parquet(log)
    stream = i.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(log)
    SN.start_anomaly_profile(stream, out, scratch_path(i.spark, "ckpt"), available_now=True).awaitTermination()
    return SN.stream_anomaly_profile(i.spark, out)


@q("dq_checks")
def _(i):
    return Q.constraint_report({
        "normalized_cdr": i.normalized, "customers": i.customers, "rate_plans": FX.rate_plans(i.spark),
        "product_catalog": FX.product_catalog(i.spark), "product_rates": i.rates,
        "rated_cdr": i.rated, "invoices": i.invoices_hist})


@q("dq_quarantine")
def _(i):
    """The same counts from the list of records that break a rule."""
    tables = {"normalized_cdr": i.normalized, "customers": i.customers, "rate_plans": FX.rate_plans(i.spark),
              "product_catalog": FX.product_catalog(i.spark), "product_rates": i.rates,
              "rated_cdr": i.rated, "invoices": i.invoices_hist}
    return Q.quarantine_report(Q.quarantine(tables, scratch_path(i.spark, "checked")), tables)


# ------------------------------------------------------------ 2.3 rating --
def _matched(i):
    return RT.split_matched(i.joined)[0]


def _parts(df):
    ts = F.col("timestamp")
    return df.select("*", R.event_hour(ts).alias("hour"), R.event_weekday(ts).alias("weekday"))


@q("rate_time_parts")
def _(i):
    return _parts(i.normalized).select("record_hash", "hour", "weekday")


@q("is_peak_hour")
def _(i):
    return _parts(i.normalized).select("record_hash", R.is_peak(F.col("hour")).alias("is_peak"))


@q("is_weekend")
def _(i):
    return _parts(i.normalized).select("record_hash", R.is_weekend(F.col("weekday")).alias("is_weekend"))


@q("is_international")
def _(i):
    return i.normalized.select("record_hash", R.is_international(F.col("peer_id")).alias("is_international"))


def _cost(i, kind):
    m = _parts(_matched(i)).where(F.col("record_type") == kind)
    c = {"voice": lambda: R.voice_cost(F.col("duration_sec"), F.col("unit_price"), F.col("hour"),
                                       F.col("weekday"), F.col("peer_id")),
         "data": lambda: R.data_cost(F.col("data_volume_mb"), F.col("unit_price")),
         "sms": lambda: R.sms_cost(F.col("unit_price"))}[kind]()
    return m.select("record_hash", c.cast("double").alias("cost"))


@q("cost_voice")
def _(i):
    return _cost(i, "voice")


@q("cost_data")
def _(i):
    return _cost(i, "data")


@q("cost_sms")
def _(i):
    return _cost(i, "sms")


@q("rate_base_cost")
def _(i):
    return rated_out(i.rated.where(F.col("rating_status") == "rated").select("record_hash", "record_type",
                                                                             "base_cost"))


@q("rate_discounts")
def _(i):
    return rated_out(i.rated.where(F.col("rating_status") == "rated").select(
        "record_hash", "final_cost", "discount_applied"))


@q("udf_surface")
def _(i):
    SQ.register_predicates(i.spark)
    return SK.run_sql(
        i.spark,
        "SELECT record_hash, is_peak_hour(hour(timestamp)) AS is_peak, "
        "is_weekend_day(dayofweek(timestamp) - 1) AS is_weekend, is_international(peer_id) AS is_international "
        "FROM {n}", n=i.normalized)


@q("udf_pricing")
def _(i):
    """The four pricing functions over the matched records."""
    SQ.register_pricing(i.spark)
    return SK.run_sql(i.spark, """
        SELECT record_hash, CAST(cost AS DOUBLE) AS base_cost, CAST(d.final_cost AS DOUBLE) AS final_cost, d.discounts
        FROM (SELECT record_hash, cost, apply_discounts(cost, activation_date, is_student, :as_of) AS d FROM (
            SELECT *, CASE record_type
                WHEN 'voice' THEN voice_cost(duration_sec, unit_price, hour(timestamp), dayofweek(timestamp) - 1, peer_id)
                WHEN 'data' THEN data_cost(data_volume_mb, unit_price) WHEN 'sms' THEN sms_cost(unit_price)
                ELSE 0 END AS cost FROM {m}))""", args={"as_of": USAGE_AS_OF}, m=_matched(i))


@q("sql_rating")
def _(i):
    """Rating through SQL alone: the table function over registered views."""
    SQ.register_rating(i.spark, i.normalized, i.customers, i.rates, i.prior_rated)
    return rated_out(SK.run_sql(i.spark, "SELECT * FROM rate(:as_of)", args={"as_of": USAGE_AS_OF}))


# ------------------------------------------------------------- 2.4 joins --
@q("join_unprocessed")
def _(i):
    prior = RT.rate(i.normalized.where(F.col("timestamp") < F.lit(PRIOR_CUTOFF)), i.customers, i.rates,
                    i.no_rated, USAGE_AS_OF)
    return RT.unprocessed(i.normalized, prior)


@q("join_unprocessed_bucketed")
def _(i):
    """Records that arrived since yesterday against the bucketed rated history:
    the stream stores the arrival, the history is read bucket by bucket."""
    log, out, ckpt = _stream_raw_folder(i), scratch_path(i.spark, "versions"), scratch_path(i.spark, "ckpt")
    _run_winners(i, log, out, ckpt)
    store = RatedStore(i.spark, f"rated_history_{uuid.uuid4().hex[:12]}", scratch_path(i.spark, "rated-store"), buckets=16)
    store.append(i.prior_rated, "first-half")
    versions = SW.read_versions(i.spark, out)
    since = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    new = RT.unprocessed(versions, store.read(), arrived_since=since)
    return SW.winners_of(new)


@q("join_customers")
def _(i):
    return RT.with_customer(i.normalized, i.customers).select("record_hash", "msisdn", "customer_id",
                                                              "rate_plan_id")


@q("join_rates")
def _(i):
    return i.joined.select("record_hash", "record_type", "rate_plan_id", F.col("unit_price").cast("double"))


@q("split_matched")
def _(i):
    m, u = RT.split_matched(i.joined)
    return (m.select("record_hash", F.lit(True).alias("matched"))
            .unionByName(u.select("record_hash", F.lit(False).alias("matched"))))


@q("join_invoiced")
def _(i):
    return B.not_yet_invoiced(i.customers, i.invoices_hist, HISTORY_PERIOD).select("customer_id", "rate_plan_id")


@q("join_customer_usage")
def _(i):
    u = B.with_usage(RT.active_customers(i.customers).select("customer_id", "rate_plan_id"),
                     B.usage_totals(i.rated, USAGE_PERIOD))
    return u.select("customer_id", "rate_plan_id", "usage_records", dbl("usage_cost"))


def _billable(i):
    return B.with_usage(B.not_yet_invoiced(i.customers, i.invoices_hist, USAGE_PERIOD)
                        .select("customer_id", "rate_plan_id", "activation_date", "is_student"),
                        B.usage_totals(i.rated, USAGE_PERIOD))


@q("join_free_units")
def _(i):
    lines = B.free_unit_lines(_billable(i), i.rates)
    return lines.select("customer_id", "service", dbl("total_usage"), dbl("free_allowance"))


@q("join_invoice_customer")
def _(i):
    return A.invoices_with_customer(i.invoices_hist, i.customers).select(
        "invoice_id", "customer_id", "billing_period", dbl("total_final_cost", 2), "customer_name", "region",
        "status")


@q("join_invoice_enriched")
def _(i):
    return i.enriched


@q("join_invoice_usage")
def _(i):
    return rated_out(A.invoices_with_usage(i.invoices_hist, i.rated_hist)).select(
        "invoice_id", "customer_id", "billing_period", "record_hash", "record_type", "final_cost")


@q("join_region_map")
def _(i):
    return i.customers.select("customer_id", "region", region_of(F.col("region")).alias("region_mapped"))


@q("semi_top_regions")
def _(i):
    monthly = A.region_monthly(i.invoices_hist, i.customers, HISTORY_AS_OF)
    return A.top_region_series(monthly, 5)


# ----------------------------------------------------------- 2.5 billing --
@q("bill_period")
def _(i):
    return (i.rated.where(F.col("timestamp").isNotNull())
            .groupBy(F.trunc(F.col("timestamp").cast("date"), "MM").alias("billing_period"))
            .agg(F.count(F.lit(1)).alias("records")))


@q("bill_usage_total")
def _(i):
    return B.usage_totals(i.rated, USAGE_PERIOD).select("customer_id", "usage_records", dbl("usage_cost"))


@q("bill_service_usage")
def _(i):
    return B.service_usage(i.rated, USAGE_PERIOD).select("customer_id", "record_type", "records",
                                                         dbl("total_usage"))


@q("bill_free_units")
def _(i):
    lines = B.free_unit_lines(_billable(i), i.rates)
    return lines.select("customer_id", "service", dbl("total_usage"), dbl("free_allowance"), dbl("free_used"),
                        dbl("credit"))


@q("bill_adjusted")
def _(i):
    return i.terms.select("customer_id", dbl("usage_cost"), dbl("credit"), dbl("adjusted"))


@q("bill_loyalty")
def _(i):
    return i.terms.select("customer_id", "is_loyal", dbl("loyalty_discount"))


@q("bill_student")
def _(i):
    return i.terms.select("customer_id", "student", dbl("student_discount"))


@q("bill_tax")
def _(i):
    return i.terms.select("customer_id", dbl("taxable"), dbl("tax"), dbl("total_due"))


def _invoice_rows(inv: DataFrame) -> DataFrame:
    return inv.select("customer_id", "billing_period",
                      *[dbl(c, 2) for c in ("total_base_cost", "total_discount", "tax_applied",
                                            "total_final_cost")])


@q("bill_invoices")
def _(i):
    return _invoice_rows(B.generate_invoices(i.customers, i.rates, i.rated, i.invoices_hist, USAGE_AS_OF))


@q("bill_documents")
def _(i):
    return B.flatten_documents(B.invoice_documents(i.customers, i.rates, i.rated, i.invoices_hist, USAGE_AS_OF))


@q("bill_document_lines")
def _(i):
    return B.invoice_lines(B.invoice_usage(i.rated_hist))


# ------------------------------------------------------ 2.6 aggregations --
@q("agg_revenue_monthly")
def _(i):
    return i.monthly


@q("agg_customer_metrics")
def _(i):
    return i.metrics


@q("agg_usage_by_service")
def _(i):
    return A.usage_by_service(i.rated_hist, HISTORY_AS_OF)


@q("agg_processing_by_day")
def _(i):
    return A.processing_by_day(i.mediated_all, USAGE_AS_OF)


@q("agg_processing_by_day_stream")
def _(i):
    """Counts by day kept up to date from a stream that stops and goes on."""
    log, out = scratch_path(i.spark, "cdr-log"), scratch_path(i.spark, "versions")
    ckpt, counts = scratch_path(i.spark, "ckpt"), scratch_path(i.spark, "daily")
    for n in range(2):
        i.raw.where(F.col("offset") % 2 == n).select("value").write.mode("append").text(log)
        _run_winners(i, log, out, ckpt, files_per_batch=1000, statuses=("ok", "error"))
        SW.refresh_daily_counts(i.spark, out, counts)
    start = USAGE_AS_OF - dt.timedelta(days=7)
    return SW.daily_counts(i.spark, counts).where(F.col("date") >= F.lit(start)).orderBy("date", "status")


def _invoice_sums(i):
    """The stored sums: all months but the last two, then those two, as they are added."""
    path = scratch_path(i.spark, "invoices")
    i.invoices_hist.write.partitionBy("billing_period").parquet(path)
    invoices = i.spark.read.schema(i.invoices_hist.schema).parquet(path)
    sums = RU.invoice_rollup(i.spark, scratch_path(i.spark, "invoice-sums"))
    added = [HISTORY_PERIOD, dt.date(2001, 6, 1)]
    sums.build_all(invoices.where(~F.col("billing_period").isin(added)))
    for month in added:
        sums.refresh(invoices, [month])
    return sums.read()


@q("agg_revenue_monthly_stored")
def _(i):
    return RU.revenue_monthly(_invoice_sums(i), HISTORY_AS_OF)


@q("agg_region_revenue_stored")
def _(i):
    return RU.region_revenue(_invoice_sums(i), i.customers, HISTORY_AS_OF)


@q("agg_region_performance_stored")
def _(i):
    usage = RU.usage_rollup(i.spark, scratch_path(i.spark, "usage-sums"))
    usage.build_all(i.rated_hist)
    return RU.region_performance(_invoice_sums(i), usage.read(), i.customers, HISTORY_AS_OF)


@q("agg_top_customers")
def _(i):
    return A.top_customers(i.customers, i.invoices_hist, HISTORY_AS_OF, n=10)


@q("agg_revenue_daily")
def _(i):
    return A.revenue_daily(i.invoices_hist, HISTORY_AS_OF)


@q("agg_service_breakdown")
def _(i):
    return A.service_breakdown(i.rated_hist, HISTORY_AS_OF)


@q("agg_region_revenue")
def _(i):
    return i.region_stats


@q("agg_region_derived")
def _(i):
    return A.with_region_ratios(i.region_stats)


@q("agg_region_monthly")
def _(i):
    return A.region_monthly(i.invoices_hist, i.customers, HISTORY_AS_OF)


@q("agg_region_performance")
def _(i):
    return A.region_performance(i.invoices_hist, i.customers, i.rated_hist, HISTORY_AS_OF)


@q("agg_region_performance_parity")
def _(i):
    return A.region_performance(i.invoices_hist, i.customers, i.rated_hist, HISTORY_AS_OF, parity=True)


@q("agg_region_perf_derived")
def _(i):
    return A.with_performance_ratios(A.region_performance(i.invoices_hist, i.customers, i.rated_hist,
                                                          HISTORY_AS_OF))


@q("agg_invoice_usage")
def _(i):
    return B.invoice_usage(i.rated_hist)


@q("agg_billing_stats")
def _(i):
    return A.billing_stats(i.invoices_hist)


@q("agg_billing_monthly")
def _(i):
    return A.billing_monthly(i.invoices_hist)


@q("agg_rating_stats")
def _(i):
    return RT.rating_stats(i.rated)


@q("agg_overview")
def _(i):
    return W.overview(i.monthly, i.metrics)


@q("agg_customer_rates")
def _(i):
    return A.with_customer_rates(i.metrics)


@q("agg_filtered_billing")
def _(i):
    return A.filtered_billing(i.enriched, FILTER_PERIOD, FILTER_REGION)


@q("agg_segment_counts")
def _(i):
    return S.segment_counts(i.rfm)


@q("agg_segment_stats")
def _(i):
    return S.segment_stats(i.rfm)


@q("agg_histogram")
def _(i):
    return S.spend_histogram(i.population, "total_spent", 10)


# ---------------------------------------------------------- 2.7 windows --
def _daily_usage_revenue(i):
    start = USAGE_AS_OF - dt.timedelta(days=30)
    return (i.rated.where((F.col("rating_status") == "rated") & (F.col("timestamp") >= F.lit(start)))
            .groupBy(F.to_date("timestamp").alias("date"))
            .agg(F.round(F.sum("final_cost"), 4).cast("double").alias("daily_revenue")))


@q("win_ma7")
def _(i):
    return W.moving_average(_daily_usage_revenue(i), "daily_revenue", "date", 7)


@q("win_growth")
def _(i):
    return W.growth(i.monthly)


@q("win_arpu")
def _(i):
    return W.arpu(i.monthly, i.metrics)


@q("win_cumulative_total")
def _(i):
    return W.window_total(i.monthly)


@q("win_target")
def _(i):
    return W.targets(i.monthly)


def _invoice_order():
    return [F.desc("billing_period"), F.asc("customer_id"), F.asc("invoice_id")]


@q("win_page")
def _(i):
    return W.page(i.enriched, _invoice_order(), 2, 5)


@q("win_page_count")
def _(i):
    return W.page_count(i.enriched, 5)


@q("invoice_detail")
def _(i):
    return B.invoice_detail(i.enriched, i.rated_hist)


@q("win_page_seek")
def _(i):
    """Page 2 of the invoice list by its place in the stored ranges."""
    order = [F.desc("billing_period"), F.asc("customer_id"), F.asc("invoice_id")]
    return PG.Pages.build(i.enriched, order, scratch_path(i.spark, "pages"), range_rows=500).page(2)


@q("win_others")
def _(i):
    return W.top_with_rest(i.region_stats, 6)


# --------------------------------------------------------- 2.8 top-k etc --
@q("topk_customers")
def _(i):
    return W.top_k(i.top20, "total_spent", 10, "customer_id")


@q("topk_regions")
def _(i):
    return W.top_k(i.region_stats, "total_revenue", 8, "region")


@q("topk_arpu")
def _(i):
    r = A.with_region_ratios(i.region_stats).select("region", F.col("avg_revenue_per_customer").alias("arpu"))
    return W.top_k(r, "arpu", 8, "region")


@q("sort_invoices")
def _(i):
    return A.sort_invoices(i.enriched)


@q("limit_sample")
def _(i):
    return W.sample_head(A.sort_invoices(i.enriched), 50)


# ------------------------------------------------------------ 2.9 sets --
@q("set_union_rated")
def _(i):
    m, u = RT.split_matched(i.joined)
    return RT.combine_rated(RT.price_matched(m, USAGE_AS_OF), RT.unmatched_rows(u)).select(
        "record_hash", "msisdn", "record_type", "customer_id", "rating_status")


@q("set_distinct_periods")
def _(i):
    return A.distinct_periods(i.enriched)


@q("set_distinct_regions")
def _(i):
    return A.distinct_regions(i.enriched)


@q("filter_period_region")
def _(i):
    return A.filter_invoices(i.enriched, FILTER_PERIOD, FILTER_REGION)


# ------------------------------------------------------------- 2.10 rfm --
@q("rfm_scores")
def _(i):
    return S.rfm_scores(i.population)


@q("rfm_segments")
def _(i):
    return i.rfm


# -------------------------------------------------------- 2.11 streaming --
@q("stream_mediation")
def _(i):
    return _run_stream(i, run_mediation)


@q("stream_dedup")
def _(i):
    def dedup_only(s):
        d = M.with_record_hash(M.validate(M.normalize_parties(decode_cdr(s))))
        return SM.dedup_stream(d).select(*[c for c in MED_COLS if c != "offset"])
    return _run_stream(i, dedup_only)


@q("stream_trigger")
def _(i):
    """The default trigger; all files are there when the first batch begins."""
    return _run_stream(i, run_mediation, trigger=SM.DEFAULT_TRIGGER, files_per_batch=1000)


@q("stream_anti_join")
def _(i):
    """Dedup against the stored dates instead of a state store."""
    def hashed(s):
        return M.to_normalized(M.keep_valid(M.with_record_hash(M.validate(M.normalize_parties(decode_cdr(s))))))
    return _run_stream(i, hashed, sink="anti_join")


def _run_winners(i, log, out, ckpt, files_per_batch=1, **options):
    stream = read_cdr_stream(i.spark, "text", log, maxFilesPerTrigger=str(files_per_batch))
    SW.start_winners(stream, out, ckpt, available_now=True, **options).awaitTermination()


@q("stream_winner")
def _(i):
    """Versions by batch, the winner decided on reading: as in one batch,
    whatever order copies of a record come in."""
    out = scratch_path(i.spark, "versions")
    _run_winners(i, _stream_raw_folder(i), out, scratch_path(i.spark, "ckpt"))
    return SW.read_winners(i.spark, out)


@q("stream_dedup_bounded")
def _(i):
    """The same behind a state store that forgets; two runs of one checkpoint."""
    out, ckpt = scratch_path(i.spark, "versions"), scratch_path(i.spark, "ckpt")
    log, late = _stream_raw_folder(i), i.raw.where("offset % 3 = 0").select("value")
    _run_winners(i, log, out, ckpt, delay="1 second", files_per_batch=2)
    late.write.mode("append").text(log)                                # delivered again, after the state forgot them
    _run_winners(i, log, out, ckpt, delay="1 second", files_per_batch=100)
    return SW.read_winners(i.spark, out)


@q("stream_accounting")
def _(i):
    """Decoded, rejected, duplicate and stored records of a stream, from the
    accounts that its batches wrote."""
    out = scratch_path(i.spark, "versions")
    _run_winners(i, _stream_raw_folder(i), out, scratch_path(i.spark, "ckpt"), accounting=True, files_per_batch=2)
    return SW.account_totals(i.spark, out)


@q("stream_recovery")
def _(i):
    """Two runs on one checkpoint: the restart resumes from the offset and
    commit logs, so the union of both runs is the full result."""
    log = scratch_path(i.spark, "cdr-log")
    out, ckpt = scratch_path(i.spark, "stream-out"), scratch_path(i.spark, "stream-ckpt")
    event_day = F.get_json_object("value", "$.timestamp")
    first = event_day < F.lit(PRIOR_CUTOFF.isoformat())
    i.raw.where(first).select("value").write.mode("overwrite").text(f"{log}/day=1")
    _run_stream(i, run_mediation, log=log, out=out, ckpt=ckpt)
    i.raw.where(~first | event_day.isNull()).select("value").write.mode("overwrite").text(f"{log}/day=2")
    return _run_stream(i, run_mediation, log=log, out=out, ckpt=ckpt)


@q("stream_graceful_stop")
def _(i):
    return _run_stream(i, run_mediation, trigger="1 second", graceful=True)


# -------------------------------------------------------- 2.12 composite --
@q("job_mediation")
def _(i):
    return run_mediation(i.raw)


@q("job_rating")
def _(i):
    return rated_out(i.new_rated)


@q("job_billing")
def _(i):
    """Invoices and documents of one run over the stored and the new usage."""
    rated = i.prior_rated.drop("usage_month").unionByName(i.new_rated)
    invoices, documents = run_billing(i.customers, i.rates, rated, i.invoices_hist, USAGE_AS_OF,
                                      stage_path=scratch_path(i.spark, "invoice-terms"))
    path = scratch_path(i.spark, "invoice-docs")
    SK.write_invoice_documents(documents, path, [PERIOD_LABEL])
    stored = i.spark.read.text(path).select(F.from_json("value", documents.schema["document"].dataType).alias("document"))
    d = B.flatten_documents(stored).select(
        "customer_id", F.col("free_units_credit").alias("document_credit"),
        F.col("free_unit_services").alias("document_services"), F.col("total_due").alias("document_total"))
    return _invoice_rows(invoices).join(d, "customer_id")


@q("job_end_to_end")
def _(i):
    return run_pipeline(i.raw, i.customers, i.rates, i.prior_rated, i.invoices_hist, USAGE_AS_OF,
                        stage_path=scratch_path(i.spark, "rated-stage"),
                        documents_path=scratch_path(i.spark, "invoice-docs"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda fn: (lambda spark, sf_dir: fn(Inputs(spark, sf_dir))))(fn)
            for name, fn in REGISTRY.items()}
