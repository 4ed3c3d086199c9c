"""Hot keys: one customer holding a large share of all usage."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterbill.operators import analytics as A
from meterbill.operators import billing as B
from meterbill.schemas import CUSTOMERS, INVOICES, RATED_CDR
from meterbill.sources.fixtures import literal_table
from meterbill.sources.tables import empty_frame
from meterbill.schemas import PRODUCT_RATES


def rated_rows(spark, n_hot=3000, n_cold=200):
    cols = RATED_CDR.fieldNames()
    def row(i, cust):
        d = {c: None for c in cols}
        d.update(record_hash=f"h{i}", record_type="sms", timestamp=dt.datetime(2024, 1, 3, 9),
                 customer_id=cust, msisdn=cust, final_cost=Decimal("0.010000"), rating_status="rated")
        return tuple(d[c] for c in cols)
    rows = [row(i, "hot") for i in range(n_hot)] + [row(n_hot + i, f"c{i % 50}") for i in range(n_cold)]
    return spark.createDataFrame(rows, RATED_CDR).repartition(8)


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_invoice_usage_join_splits_hot_customer_month(spark, skew_conf):
    r = rated_rows(spark)
    inv = spark.createDataFrame(
        [(1, "hot", dt.date(2024, 1, 1), Decimal("9.99")), (2, "c1", dt.date(2024, 1, 1), Decimal("1.00")),
         (3, "nobody", dt.date(2024, 1, 1), Decimal("2.00"))],
        "invoice_id long, customer_id string, billing_period date, total_final_cost decimal(18,2)")
    out = A.invoices_with_usage(inv, r)
    got = {row["customer_id"]: row["n"] for row in out.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
           .collect()}
    assert got == {"hot": 3000, "c1": 4, "nobody": 1}
    out.collect()                      # final adaptive plan of this query execution
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_billing_hot_customer_is_exact(spark):
    r = rated_rows(spark)
    cols = CUSTOMERS.fieldNames()
    base = dict(customer_name="n", subscription_type="postpaid", rate_plan_id="P",
                activation_date=dt.date(2023, 6, 1), status="active", region="RABAT", is_student=False)
    cust = spark.createDataFrame([tuple({**base, "customer_id": c}[k] for k in cols)
                                  for c in ["hot"] + [f"c{i}" for i in range(50)]], CUSTOMERS)
    rates = literal_table(spark, [("P", "sms", 0.01, 0)], PRODUCT_RATES)
    inv = {x["customer_id"]: x for x in B.generate_invoices(cust, rates, r, empty_frame(spark, INVOICES),
                                                           dt.date(2024, 1, 31)).collect()}
    assert inv["hot"]["total_base_cost"] == Decimal("30.00")
    assert inv["hot"]["total_final_cost"] == Decimal("37.00")     # 30 * 1.2 + 1
    assert len(inv) == 51


def test_rating_customer_join_splits_hot_msisdn(spark, skew_conf):
    from meterbill.operators import rating as RT
    from meterbill.schemas import NORMALIZED_CDR
    cols = NORMALIZED_CDR.fieldNames()

    def cdr(i, m):
        d = dict(record_type="sms", timestamp=dt.datetime(2024, 1, 3, 9), msisdn=m, peer_id="212600000002",
                 duration_sec=None, data_volume_mb=None, session_duration_sec=None, cell_id="C", technology="4G",
                 status="ok", record_hash=f"h{i}")
        return tuple(d[c] for c in cols)
    n = spark.createDataFrame([cdr(i, "hot") for i in range(3000)] + [cdr(5000 + i, f"c{i % 300}") for i in range(300)],
                              NORMALIZED_CDR).repartition(8)
    base = dict(customer_name="n", subscription_type="postpaid", rate_plan_id="P",
                activation_date=dt.date(2023, 6, 1), status="active", region="RABAT", is_student=False)
    cust = spark.createDataFrame([tuple({**base, "customer_id": c}[k] for k in CUSTOMERS.fieldNames())
                                  for c in ["hot"] + [f"c{i}" for i in range(300)]], CUSTOMERS)
    out = RT.with_customer(n, cust)
    rows = out.collect()
    assert len(rows) == 3300 and all(r["customer_id"] is not None for r in rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and ("isSkewJoin=true" in plan or "skew=true" in plan)
