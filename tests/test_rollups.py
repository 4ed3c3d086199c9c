"""Stored sums, pages by seeking, results kept by meaning, quarantine, daily counts of a stream."""

import datetime as dt
import json

from pyspark.sql import functions as F

from meterbill.operators import analytics as A
from meterbill.operators import mediation as M
from meterbill.operators import pages as PG
from meterbill.operators import quality as Q
from meterbill.operators import rollups as RU
from meterbill.plans.catalog import HISTORY_AS_OF, HISTORY_PERIOD, USAGE_AS_OF, Inputs
from meterbill.sources import fixtures as FX
from meterbill.sources.cdr import decode_cdr, read_cdr_stream
from meterbill.sources.result_cache import ResultCache
from meterbill.streaming import winners as SW
from tests_support import rec, write_log

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def test_one_month_is_read_for_one_month(spark, scratch):
    i = Inputs(spark, SF)
    path = scratch("invoices")
    i.invoices_hist.write.partitionBy("billing_period").parquet(path)
    stored = lambda: spark.read.schema(i.invoices_hist.schema).parquet(path)
    sums = RU.invoice_rollup(spark, scratch("sums"))
    assert sums.read().count() == 0
    sums.build_all(stored())
    # a month's invoices arrive
    more = i.invoices_hist.where(F.col("billing_period") == HISTORY_PERIOD).withColumn("customer_id", F.lit("212600000001"))
    more.write.mode("append").partitionBy("billing_period").parquet(path)
    source = stored().where(F.col("billing_period").isin([HISTORY_PERIOD]))
    scan = next(x for x in sums.build(source)._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    assert "billing_period" in scan.split("PartitionFilters")[1].split("]")[0]
    files = lambda: {(r["billing_period"], r["f"]) for r in sums.read().select("billing_period", F.input_file_name().alias("f")).collect()}
    before = files()
    for _ in range(2):                                        # a repeated refresh changes nothing
        sums.refresh(stored(), [HISTORY_PERIOD])
        assert rows(RU.revenue_monthly(sums.read(), HISTORY_AS_OF)) == rows(A.revenue_monthly(stored(), HISTORY_AS_OF))
        assert rows(RU.region_revenue(sums.read(), i.customers, HISTORY_AS_OF)) == rows(A.region_revenue(stored(), i.customers, HISTORY_AS_OF))
    assert {period for period, _ in files() ^ before} == {HISTORY_PERIOD}


def test_region_performance_from_sums(spark, scratch):
    i = Inputs(spark, SF)
    # two invoices of one customer in one month: its usage counts for each
    twice = i.invoices_hist.unionByName(i.invoices_hist.where("pmod(invoice_id, 5) = 0"))
    sums, usage = RU.invoice_rollup(spark, scratch("sums")), RU.usage_rollup(spark, scratch("usage"))
    sums.build_all(twice)
    usage.build_all(i.rated_hist)
    got = RU.region_performance(sums.read(), usage.read(), i.customers, HISTORY_AS_OF)
    assert rows(got) == rows(A.region_performance(twice, i.customers, i.rated_hist, HISTORY_AS_OF))


def test_all_pages_are_the_sorted_list(spark, scratch):
    order = [F.desc("billing_period"), F.asc("customer_id"), F.asc("invoice_id")]
    enriched = Inputs(spark, SF).enriched
    pages = PG.Pages.build(enriched, order, scratch("pages"), range_rows=200)
    assert pages.index().count() > 3
    want = [tuple(r) for r in A.sort_invoices(enriched).collect()]
    size = 97                                                 # pages that cross ranges
    total = pages.count(size).first()
    assert (total["total_items"], total["total_pages"]) == (len(want), -(-len(want) // size))
    got = [tuple(r) for n in range(1, total["total_pages"] + 1) for r in pages.page(n, size).collect()]
    assert got == want
    assert pages.page(total["total_pages"] + 1, size).count() == 0
    far = pages.page(len(want) // 5 - 1, 5)
    scan = next(x for x in far._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    assert "_range" in scan.split("PartitionFilters")[1].split("]")[0]
    whole = spark.read.parquet(f"{pages.path}/rows").select(F.input_file_name().alias("f"))
    first = far.inputFiles()
    assert whole.distinct().count() >= pages.index().count() and first
    empty = PG.Pages.build(enriched.limit(0), order, scratch("pages"))
    assert empty.page(1).count() == 0 and empty.count().first()["total_pages"] == 0


def test_small_ranges_of_a_long_list_are_few(spark, scratch):
    """Not a task and a folder for every ``range_rows`` rows, and every page is still right."""
    pages = PG.Pages.build(spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("x")), [F.desc("id")], scratch("pages"), range_rows=2)
    index = pages.index().orderBy("start").collect()
    assert len(index) <= PG.FEW_RANGES
    assert [r["start"] for r in index] == [sum(r["rows"] for r in index[:n]) for n in range(len(index))] and sum(r["rows"] for r in index) == 3000
    for number in (1, 2, 301, 600):
        assert [r["id"] for r in pages.page(number, 5).collect()] == [2999 - (number - 1) * 5 - k for k in range(5)]
    assert pages.page(601, 5).count() == 0


def test_results_are_kept_by_meaning(spark, scratch):
    path, clock = scratch("t"), [0.0]
    spark.range(100).write.parquet(path)
    query = lambda least: spark.read.parquet(path).where(F.col("id") >= least).groupBy((F.col("id") % 7).alias("k")).count()
    cache = ResultCache(ttl_s=300, clock=lambda: clock[0])
    assert cache.get(query(10)).agg(F.sum("count")).first()[0] == 90
    kept = cache.get(query(10))                               # an equal plan, built anew
    assert (cache.hits, cache.misses) == (1, 1) and kept.storageLevel.useMemory
    cache.get(query(20))                                      # another argument
    assert (cache.hits, cache.misses) == (1, 2)
    spark.range(100, 150).write.mode("append").parquet(path)
    assert cache.get(query(10)).agg(F.sum("count")).first()[0] == 140
    assert (cache.hits, cache.misses) == (1, 3)
    clock[0] = 301.0
    cache.get(query(10))
    assert (cache.hits, cache.misses) == (1, 4)               # too old
    small = ResultCache(max_bytes=1)
    for least in range(5):
        small.get(query(least)).count()
    assert len(small._held) == 1
    cache.clear()
    small.clear()
    assert not cache._held and not small._held


def test_quarantine_lists_what_the_report_counts(spark, scratch):
    good = FX.customers(spark, SF)
    one = good.limit(1)
    bad = (good.unionByName(one).unionByName(one).unionByName(one.withColumn("status", F.lit("gone")))
           .unionByName(one.withColumn("customer_id", F.lit(None).cast("string"))))
    rates = FX.product_rates(spark)
    rates = rates.unionByName(rates.limit(1).withColumn("rate_plan_id", F.lit("RP_NOWHERE")))
    tables = {"customers": bad, "rate_plans": FX.rate_plans(spark), "product_rates": rates, "product_catalog": FX.product_catalog(spark)}
    rejected = Q.quarantine(tables, scratch("checked"))
    want = {(r["table_name"], r["check_name"]): r["violations"] for r in Q.constraint_report(tables).collect()}
    got = {(r["table_name"], r["check_name"]): r["violations"] for r in Q.quarantine_report(rejected, tables).collect()}
    assert got == want
    assert got["customers", "primary_key"] == 4 and got["customers", "check_status"] == 1 and got["product_rates", "foreign_key_rate_plan"] == 1
    listed = rejected.where("check_name = 'foreign_key_rate_plan'").first()
    assert json.loads(listed["record"])["rate_plan_id"] == "RP_NOWHERE" and listed["copies"] == 1
    assert {json.loads(r["record"]).get("customer_id") for r in rejected.where("check_name = 'primary_key'").collect()} == {
        None, one.first()["customer_id"]}


def test_daily_counts_follow_the_stream(spark, scratch):
    log, out, ckpt, counts = scratch("log"), scratch("out"), scratch("ckpt"), scratch("daily")
    days = [[rec(1), rec(2), rec(3, duration=-1), {**rec(4), "timestamp": "2024-01-06T08:00:00.000000Z"}],
            [rec(2), rec(3), rec(5, caller="33600000000"), {**rec(6), "timestamp": "garbage"}]]
    assert SW.refresh_daily_counts(spark, out, counts) == 0 and SW.daily_counts(spark, counts).count() == 0
    recounted = []
    for n, records in enumerate(days):
        write_log(spark, f"{log}/day={n}", records)
        SW.start_winners(read_cdr_stream(spark, "text", log, maxFilesPerTrigger="1"), out, ckpt, available_now=True,
                         statuses=("ok", "error")).awaitTermination()
        recounted.append(SW.refresh_daily_counts(spark, out, counts))
        assert SW.refresh_daily_counts(spark, out, counts) == 0     # nothing new, nothing read
    assert recounted == [2, 1]
    everything = spark.createDataFrame([(json.dumps(r),) for d in days for r in d], "value string")
    want = A.processing_by_day(M.mediate_all(decode_cdr(everything)), dt.date(2024, 1, 8))
    assert rows(SW.daily_counts(spark, counts)) == rows(want.select("date", "status", "count"))
    assert USAGE_AS_OF
