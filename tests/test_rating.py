import datetime as dt
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from meterbill.functions import rating as R
from meterbill.operators import rating as RT
from meterbill.schemas import NORMALIZED_CDR, RATED_CDR
from meterbill.sources.fixtures import literal_table
from meterbill.sources.tables import empty_frame
from meterbill.schemas import CUSTOMERS, PRODUCT_RATES

AS_OF = dt.date(2024, 1, 31)


def cdr(spark, rows):
    full = []
    for i, r in enumerate(rows):
        d = {"record_type": "voice", "timestamp": dt.datetime(2024, 1, 10, 10, 0), "msisdn": "212600000001",
             "peer_id": "212600000002", "duration_sec": 100, "data_volume_mb": None,
             "session_duration_sec": None, "cell_id": "C", "technology": "4G", "status": "ok",
             "record_hash": f"h{i}"}
        d.update(r)
        full.append(tuple(d[f] for f in NORMALIZED_CDR.fieldNames()))
    return spark.createDataFrame(full, NORMALIZED_CDR)


def customers(spark, rows):
    base = {"customer_name": "n", "subscription_type": "postpaid", "rate_plan_id": "P",
            "activation_date": dt.date(2023, 6, 1), "status": "active", "region": "RABAT", "is_student": False}
    return spark.createDataFrame([tuple({**base, **r}[f] for f in CUSTOMERS.fieldNames()) for r in rows], CUSTOMERS)


def rates(spark):
    return literal_table(spark, [("P", "voice", 0.01, 0), ("P", "sms", 0.05, 5), ("P", "data", 0.02, 0)],
                         PRODUCT_RATES)


def test_time_predicates(spark):
    df = spark.createDataFrame([(h,) for h in (None, 7, 8, 19, 20)], "h int")
    assert [r[0] for r in df.select(R.is_peak(F.col("h"))).collect()] == [False, False, True, True, False]
    # 2024-01-05 Fri, 06 Sat, 07 Sun, 08 Mon
    days = spark.createDataFrame([(dt.datetime(2024, 1, d, 12),) for d in (5, 6, 7, 8)], "ts timestamp")
    wd = days.select(R.event_weekday(F.col("ts")).alias("wd"))
    assert [r[0] for r in wd.collect()] == [5, 6, 0, 1]
    assert [r[0] for r in wd.select(R.is_weekend(F.col("wd"))).collect()] == [True, True, False, False]
    peers = spark.createDataFrame([(None,), ("212600000001",), ("+33612345678",)], "p string")
    assert [r[0] for r in peers.select(R.is_international(F.col("p"))).collect()] == [False, False, True]


def test_voice_cost_modifiers(spark):
    # Saturday 10:00, international, 100 s at 0.01 -> 100*0.01*1.2*0.9*2.0
    df = spark.createDataFrame([(100, 0.01, dt.datetime(2024, 1, 6, 10), "+33600000000"),
                                (100, 0.01, dt.datetime(2024, 1, 8, 7), "212600000002"),
                                (None, 0.01, dt.datetime(2024, 1, 8, 7), None)],
                               "d int, p double, ts timestamp, peer string")
    c = R.voice_cost(F.col("d"), F.col("p"), R.event_hour(F.col("ts")), R.event_weekday(F.col("ts")), F.col("peer"))
    got = [r[0] for r in df.select(c).collect()]
    assert got == [Decimal("2.160000"), Decimal("1.000000"), Decimal("0.000000")]


def test_rate_prices_discounts_and_unmatched(spark):
    n = cdr(spark, [{},                                                      # voice, peak weekday
                    {"record_type": "sms", "msisdn": "212600000002"},        # student
                    {"record_type": "data", "data_volume_mb": 12.5, "duration_sec": None},
                    {"msisdn": "212699999999"},                              # no customer
                    {"record_type": "ping"}])                                # no tariff
    c = customers(spark, [{"customer_id": "212600000001", "activation_date": AS_OF - dt.timedelta(days=365)},
                          {"customer_id": "212600000002", "is_student": True,
                           "activation_date": AS_OF - dt.timedelta(days=364)}])
    out = {r["record_hash"]: r for r in RT.rate(n, c, rates(spark), empty_frame(spark, RATED_CDR), AS_OF).collect()}
    assert out["h0"]["base_cost"] == Decimal("1.200000")            # 100 * 0.01 * 1.2
    assert out["h0"]["final_cost"] == Decimal("1.140000")           # loyal: exactly 365 days
    assert out["h0"]["discount_applied"] == "loyalty_5%"
    assert out["h1"]["final_cost"] == Decimal("0.045000")           # 0.05 * 0.9, 364 days: not loyal
    assert out["h1"]["discount_applied"] == "student_10%"
    assert out["h2"]["base_cost"] == Decimal("0.250000") and out["h2"]["final_cost"] == Decimal("0.237500")
    for h in ("h3", "h4"):
        r = out[h]
        assert r["rating_status"] == "unmatched" and r["msisdn"] is not None
        assert all(r[f] is None for f in RATED_CDR.fieldNames() if f not in ("record_hash", "msisdn", "rating_status"))


def test_rate_equals_split_and_union(spark):
    n = cdr(spark, [{}, {"msisdn": "212699999999"}, {"record_type": "ping"}, {"record_type": "sms"}])
    c = customers(spark, [{"customer_id": "212600000001"}])
    r, none = rates(spark), empty_frame(spark, RATED_CDR)
    one_pass = RT.rate(n, c, r, none, AS_OF)
    joined = RT.with_rate(RT.with_customer(RT.unprocessed(n, none), c), r)
    m, u = RT.split_matched(joined)
    two_pass = RT.combine_rated(RT.price_matched(m, AS_OF), RT.unmatched_rows(u))
    assert sorted(map(tuple, one_pass.collect())) == sorted(map(tuple, two_pass.collect()))


def test_rating_is_idempotent(spark):
    n = cdr(spark, [{}, {"record_type": "sms"}, {"msisdn": "212699999999"}])
    c = customers(spark, [{"customer_id": "212600000001"}])
    first = RT.rate(n, c, rates(spark), empty_frame(spark, RATED_CDR), AS_OF)
    assert first.count() == 3
    second = RT.rate(n, c, rates(spark), first, AS_OF)
    assert second.count() == 0            # unmatched hashes are not retried either


def test_rating_ignores_input_order(spark):
    rows = [{}, {"record_type": "sms"}, {"msisdn": "212699999999"}, {"record_type": "data", "data_volume_mb": 3.3}]
    c = customers(spark, [{"customer_id": "212600000001"}])
    a = RT.rate(cdr(spark, rows), c, rates(spark), empty_frame(spark, RATED_CDR), AS_OF)
    b = RT.rate(cdr(spark, rows).orderBy(F.rand(7)).repartition(3), c, rates(spark),
                empty_frame(spark, RATED_CDR), AS_OF)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sql_functions_registered(spark):
    R.register_sql_functions(spark)
    row = spark.sql("SELECT is_peak_hour(8) AS a, is_peak_hour(20) AS b, is_weekend_day(6) AS c, "
                    "is_international('+44') AS d, is_international(NULL) AS e").collect()[0]
    assert tuple(row) == (True, False, True, True, False)


def test_incremental_window_prunes_history_but_stays_exact(spark, scratch):
    from meterbill.sources.sinks import write_rated
    early = {"timestamp": dt.datetime(2024, 1, 2, 10)}
    late = {"timestamp": dt.datetime(2024, 2, 20, 10)}
    rows = [dict(early), {**early, "msisdn": "212699999999"}, dict(late), {**late, "msisdn": "212699999999"}]
    n = cdr(spark, rows)
    c = customers(spark, [{"customer_id": "212600000001"}])
    path = scratch("rated-table")
    # first run rated January; an unmatched February row was also rated already
    first = RT.rate(n.where(F.col("record_hash").isin("h0", "h1", "h3")), c, rates(spark),
                    empty_frame(spark, RATED_CDR), AS_OF)
    write_rated(first, path)
    stored = spark.read.parquet(path)
    full = RT.rate(n, c, rates(spark), stored, AS_OF)
    windowed = RT.rate(n, c, rates(spark), stored, AS_OF, arrived_since=dt.date(2024, 2, 1))
    assert [r["record_hash"] for r in full.collect()] == ["h2"]
    assert [r["record_hash"] for r in windowed.collect()] == ["h2"]     # h3 (unmatched) not re-rated
    plan = windowed._jdf.queryExecution().executedPlan().toString()
    assert "usage_month" in plan and "PartitionFilters" in plan


def test_incremental_run_keeps_late_and_untimed_records(spark):
    """Bounded by arrival: event times do not matter, null ones included."""
    rows = [{"timestamp": dt.datetime(2024, 1, 2, 10)}, {"timestamp": None}, {"timestamp": dt.datetime(2024, 2, 20, 10)}]
    n = cdr(spark, rows).withColumn("arrival_date", F.when(F.col("record_hash") == "h2", F.lit(dt.date(2024, 2, 1)))
                                    .otherwise(F.lit(dt.date(2024, 2, 21))))
    new = RT.unprocessed(n, empty_frame(spark, RATED_CDR), arrived_since=dt.date(2024, 2, 21))
    assert sorted(r["record_hash"] for r in new.collect()) == ["h0", "h1"]


def test_data_cost_is_exact_and_safe(spark):
    df = spark.createDataFrame([(0.004, 0.02), (1.239, 0.02), (1e11, 0.02), (1e30, 0.02), (None, 0.02)], "mb double, p double")
    got = [r[0] for r in df.select(R.data_cost(F.col("mb"), F.col("p")).cast("double")).collect()]
    assert got == [0.00008, 0.02478, 2e9, None, 0.0]
    ok = [r[0] for r in df.select(R.is_priceable(F.lit("data"), F.col("mb"), F.col("p"))).collect()]
    assert ok == [True, True, True, False, True]
