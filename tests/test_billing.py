import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from meterbill.operators import billing as B
from meterbill.schemas import CUSTOMERS, INVOICES, PRODUCT_RATES, RATED_CDR
from meterbill.sources.fixtures import literal_table
from meterbill.sources.tables import empty_frame
from meterbill.sources import sinks as SK

AS_OF = dt.date(2024, 1, 31)
PERIOD = dt.date(2024, 1, 1)


def rated(spark, rows):
    out = []
    for i, r in enumerate(rows):
        d = {f: None for f in RATED_CDR.fieldNames()}
        d.update({"record_hash": f"h{i}", "record_type": "sms", "timestamp": dt.datetime(2024, 1, 10, 12),
                  "msisdn": "c1", "customer_id": "c1", "status": "ok", "final_cost": Decimal("0.100000"),
                  "base_cost": Decimal("0.100000"), "unit_price": Decimal("0.0500"), "rating_status": "rated"})
        d.update(r)
        out.append(tuple(d[f] for f in RATED_CDR.fieldNames()))
    return spark.createDataFrame(out, RATED_CDR)


def customers(spark, rows):
    base = {"customer_name": "n", "subscription_type": "postpaid", "rate_plan_id": "P",
            "activation_date": dt.date(2020, 1, 1), "status": "active", "region": "RABAT", "is_student": False}
    return spark.createDataFrame([tuple({**base, **r}[f] for f in CUSTOMERS.fieldNames()) for r in rows], CUSTOMERS)


def rates(spark):
    return literal_table(spark, [("P", "voice", 0.01, 2), ("P", "sms", 0.05, 3), ("P", "data", 0.02, 100)],
                         PRODUCT_RATES)


def no_invoices(spark):
    return empty_frame(spark, INVOICES)


def test_free_units_below_equal_above(spark):
    # c1: 2 sms (below 3); c2: 3 sms (equal); c3: 5 sms (above) and no voice/data
    rows = ([{"customer_id": "c1"}] * 2 + [{"customer_id": "c2"}] * 3 + [{"customer_id": "c3"}] * 5
            + [{"customer_id": "c1", "record_type": "voice", "duration_sec": 150},
               {"customer_id": "c1", "record_type": "data", "data_volume_mb": 40.5}])
    r = rated(spark, rows)
    c = customers(spark, [{"customer_id": x} for x in ("c1", "c2", "c3")])
    billable = B.with_usage(c, B.usage_totals(r, PERIOD))
    lines = {(x["customer_id"], x["service"]): x for x in B.free_unit_lines(billable, rates(spark)).collect()}
    assert len(lines) == 9                                   # every service with an allowance has a line
    assert lines[("c1", "sms")]["free_used"] == Decimal(2) and lines[("c2", "sms")]["free_used"] == Decimal(3)
    assert lines[("c3", "sms")]["free_used"] == Decimal(3)
    assert lines[("c3", "voice")]["total_usage"] == 0 and lines[("c3", "voice")]["credit"] == 0
    assert lines[("c1", "voice")]["free_allowance"] == Decimal(120)    # minutes -> seconds
    assert lines[("c1", "voice")]["free_used"] == Decimal(120)
    assert lines[("c1", "voice")]["credit"] == Decimal("1.200000")    # list price, no modifiers
    assert lines[("c1", "data")]["credit"] == Decimal("0.810000")


def test_loyalty_months_and_student(spark):
    # 2023-01-15 -> 12 months at 2024-01 (not loyal); 2022-12-31 -> 13 months (loyal)
    c = customers(spark, [{"customer_id": "c1", "activation_date": dt.date(2023, 1, 15)},
                          {"customer_id": "c2", "activation_date": dt.date(2022, 12, 31), "is_student": True},
                          {"customer_id": "c3", "activation_date": None}])
    r = rated(spark, [{"customer_id": x, "final_cost": Decimal("10.000000")} for x in ("c1", "c2", "c3")])
    t = {x["customer_id"]: x for x in B.invoice_terms(c, rates(spark), r, no_invoices(spark), AS_OF).collect()}
    assert not t["c1"]["is_loyal"] and t["c2"]["is_loyal"] and not t["c3"]["is_loyal"]
    # one sms each -> credit 0.05; adjusted 9.95
    assert t["c2"]["adjusted"] == Decimal("9.950000")
    assert t["c2"]["discount"] == Decimal("9.95") * Decimal("0.15")   # additive 5% + 10%


def test_invoice_invariants_and_rounding(spark):
    rows = ([{"customer_id": f"c{i}", "final_cost": Decimal(f"{i}.123457")} for i in range(1, 6)]
            + [{"customer_id": "c2", "record_type": "voice", "duration_sec": 500, "final_cost": Decimal("3.333333")}])
    c = customers(spark, [{"customer_id": f"c{i}", "is_student": i % 2 == 0,
                           "activation_date": dt.date(2023, 6, 1) if i == 3 else dt.date(2020, 1, 1)}
                          for i in range(1, 6)])
    docs = B.flatten_documents(B.invoice_documents(c, rates(spark), rated(spark, rows), no_invoices(spark), AS_OF))
    for d in docs.collect():
        assert abs(d["adjusted_usage_cost"] - max(0.0, d["total_base_cost"] - d["free_units_credit"])) <= 0.0101
        loyal = 0.05 if d["loyalty_discount"] > 0 else 0.0
        student = 0.10 if d["student_discount"] > 0 else 0.0
        sub = d["adjusted_usage_cost"] * (1 - loyal - student)
        assert abs(d["subtotal_after_discounts"] - sub) <= 0.0101
        assert abs(d["vat"] - 0.2 * d["subtotal_after_discounts"]) <= 0.0101
        assert abs(d["total_due"] - (1.2 * d["subtotal_after_discounts"] + 1.0)) <= 0.0101
        assert d["regulatory_fee"] == 1.0


def test_billing_is_idempotent_and_skips_empty(spark):
    c = customers(spark, [{"customer_id": "c1"}, {"customer_id": "c2"}, {"customer_id": "c3", "status": "suspended"}])
    r = rated(spark, [{"customer_id": "c1"}, {"customer_id": "c3"},
                      {"customer_id": "c1", "rating_status": "unmatched"},
                      {"customer_id": "c1", "timestamp": dt.datetime(2023, 12, 31, 23, 59)}])
    first = B.generate_invoices(c, rates(spark), r, no_invoices(spark), AS_OF)
    got = first.collect()
    assert [x["customer_id"] for x in got] == ["c1"]          # c2 has no usage, c3 is not active
    assert got[0]["billing_period"] == PERIOD
    again = B.generate_invoices(c, rates(spark), r, first, AS_OF)
    assert again.count() == 0


def test_invoice_id_is_stable(spark):
    c = customers(spark, [{"customer_id": "c1"}])
    r = rated(spark, [{"customer_id": "c1"}])
    a = B.generate_invoices(c, rates(spark), r, no_invoices(spark), AS_OF).select("invoice_id").collect()
    b = B.generate_invoices(c, rates(spark), r, no_invoices(spark), AS_OF).select("invoice_id").collect()
    assert a == b


def test_documents_written_as_json(spark, scratch):
    c = customers(spark, [{"customer_id": "c1", "is_student": True}])
    r = rated(spark, [{"customer_id": "c1", "final_cost": Decimal("7.000000")}])
    docs = B.invoice_documents(c, rates(spark), r, no_invoices(spark), AS_OF)
    path = scratch("docs")
    SK.write_invoice_documents(docs, path)
    text = spark.read.text(f"{path}/billing_period=2024-01").collect()
    doc = json.loads(text[0][0])
    assert doc["billing_period"] == "2024-01" and doc["customer_id"] == "c1"
    assert set(doc["free_units_details"]) == {"voice", "sms", "data"}
    assert doc["charges"]["vat_20%"] == round(doc["charges"]["subtotal_after_discounts"] * 0.2, 2)
    assert doc["discounts"]["student_discount"] > 0


def test_invoice_lines_format(spark):
    usage = spark.createDataFrame(
        [("c1", dt.date(2025, 6, 1), "voice", 3, 185, None, 1.234, 1.0),
         ("c1", dt.date(2025, 6, 1), "data", 2, None, 12.25, 0.5, 0.45),
         ("c1", dt.date(2025, 6, 1), "sms", 4, None, None, 0.2, 0.2)],
        "customer_id string, billing_period date, record_type string, usage_count long, total_duration_sec long, "
        "total_data_mb double, total_base_cost double, total_final_cost double")
    got = {r["record_type"]: r for r in B.invoice_lines(usage).collect()}
    assert got["voice"]["quantity"] == "3 minutes" and got["voice"]["period_label"] == "June 2025"
    assert got["data"]["quantity"] == "12.3 MB"
    assert got["sms"]["quantity"] == "4 messages"
    assert got["voice"]["base_amount"] == "1.23 MAD" and got["data"]["final_amount"] == "0.45 MAD"


def test_documents_of_other_months_survive_a_rerun(spark, scratch):
    c = customers(spark, [{"customer_id": "c1"}])
    path = scratch("docs")
    jan = rated(spark, [{"customer_id": "c1"}])
    feb = rated(spark, [{"customer_id": "c1", "timestamp": dt.datetime(2024, 2, 10, 12)}])
    SK.write_invoice_documents(B.invoice_documents(c, rates(spark), jan, no_invoices(spark), AS_OF), path)
    SK.write_invoice_documents(B.invoice_documents(c, rates(spark), feb, no_invoices(spark),
                                                   dt.date(2024, 2, 29)), path)
    SK.write_invoice_documents(B.invoice_documents(c, rates(spark), feb, no_invoices(spark),
                                                   dt.date(2024, 2, 29)), path)     # re-run February
    got = sorted(r["billing_period"] for r in spark.read.text(path).select("billing_period").collect())
    assert [str(x) for x in got] == ["2024-01", "2024-02"]


def test_late_usage_adds_documents(spark, scratch):
    """A second run of a month keeps the documents of the first."""
    c = customers(spark, [{"customer_id": "c1"}, {"customer_id": "c2"}])
    path = scratch("docs")
    first = rated(spark, [{"customer_id": "c1"}])
    SK.write_invoice_documents(B.invoice_documents(c, rates(spark), first, no_invoices(spark), AS_OF), path)
    both = rated(spark, [{"customer_id": "c1"}, {"customer_id": "c2"}])
    SK.write_invoice_documents(B.invoice_documents(c, rates(spark), both, no_invoices(spark), AS_OF), path)
    got = sorted(json.loads(r["value"])["customer_id"] for r in spark.read.text(path).collect())
    assert got == ["c1", "c2"]


def test_documents_of_a_month_read_its_folder(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F
    path = scratch("docs")
    docs = spark.createDataFrame([(("c1", "2024-01"),), (("c1", "2024-02"),), (("c2", "2024-02"),)],
                                 "document struct<customer_id:string,billing_period:string>")
    SK.write_invoice_documents(docs.where("document.billing_period = '2024-01'"), path, ["2024-01"])
    plans, plain = [], type(docs).join

    def spied(self, other, *a, **k):
        plans.append(other._jdf.queryExecution().executedPlan().toString())
        return plain(self, other, *a, **k)
    monkeypatch.setattr(type(docs), "join", spied)
    for _ in range(2):
        SK.write_invoice_documents(docs, path, ["2024-02"])
    monkeypatch.undo()
    assert all("billing_period" in p.split("PartitionFilters")[1].split("]")[0] and "2024-02" in p for p in plans) and len(plans) == 2
    kept = spark.read.text(path).groupBy("billing_period").agg(F.count("*").alias("n")).collect()
    assert {str(r["billing_period"]): r["n"] for r in kept} == {"2024-01": 1, "2024-02": 2}
