"""Pricing through SQL: the functions, and rating as a table function."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterbill.functions import rating as R
from meterbill.functions import sql as S
from meterbill.operators import rating as RT
from meterbill.plans.catalog import USAGE_AS_OF, Inputs
from meterbill.schemas import RATED_CDR

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 1, 31)


@pytest.fixture()
def one(spark):
    S.register_pricing(spark)
    return lambda text: spark.sql(f"SELECT {text} AS x").first()["x"]


def test_costs(one):
    assert one("voice_cost(60, 0.5, 7, 1, '212600000001')") == Decimal("30.000000")
    assert one("voice_cost(60, 0.5, 8, 5, '33600000001')") == Decimal("64.800000")      # peak, weekend, abroad
    assert one("voice_cost(NULL, 0.5, 8, 5, NULL)") == 0 and one("voice_cost(60, NULL, 8, 5, NULL)") == 0
    assert one("voice_cost(60, 0.5, NULL, NULL, NULL)") == 30
    assert one("data_cost(1.5, 0.05)") == Decimal("0.075000") and one("data_cost(NULL, 0.05)") == 0
    assert one("data_cost(1e30, 0.05)") is None                                         # too large for money
    assert one("sms_cost(0.4)") == Decimal("0.400000") and one("sms_cost(NULL)") == 0
    assert one("base_cost('ping', 60, 1.0, 0.5, TIMESTAMP'2024-01-05 10:00:00', NULL)") == 0
    assert one("base_cost('sms', 60, 1.0, 0.5, TIMESTAMP'2024-01-05 10:00:00', NULL)") == Decimal("0.5")


def test_discounts(one):
    d = lambda *a: tuple(one(f"apply_discounts({', '.join(a)}, DATE'2024-01-31')"))
    assert d("100", "DATE'2023-01-31'", "true") == (Decimal("85.500000"), "loyalty_5%,student_10%")
    assert d("100", "DATE'2023-02-01'", "true") == (Decimal("90.000000"), "student_10%")
    assert d("100", "DATE'2020-02-01'", "false") == (Decimal("95.000000"), "loyalty_5%")
    assert d("100", "NULL", "NULL") == (Decimal("100.000000"), None)
    assert d("NULL", "DATE'2020-02-01'", "true")[0] is None


def test_functions_equal_the_columns(spark):
    """On every matched record, all four functions against the DataFrame arithmetic."""
    S.register_pricing(spark)
    i = Inputs(spark, SF)
    m, _ = RT.split_matched(i.joined)
    hour, day = R.event_hour(F.col("timestamp")), R.event_weekday(F.col("timestamp"))
    got = m.selectExpr("record_hash", "voice_cost(duration_sec, unit_price, hour(timestamp), dayofweek(timestamp) - 1, peer_id) AS v",
                       "data_cost(data_volume_mb, unit_price) AS d", "sms_cost(unit_price) AS s",
                       "apply_discounts(sms_cost(unit_price), activation_date, is_student, DATE'2024-01-31') AS a")
    want = m.select("record_hash", R.voice_cost(F.col("duration_sec"), F.col("unit_price"), hour, day, F.col("peer_id")).alias("v"),
                    R.data_cost(F.col("data_volume_mb"), F.col("unit_price")).alias("d"), R.sms_cost(F.col("unit_price")).alias("s"),
                    F.struct(R.discounted_cost(R.sms_cost(F.col("unit_price")), F.col("activation_date"), F.col("is_student"), AS_OF).alias("final_cost"),
                             R.discount_tags(F.col("activation_date"), F.col("is_student"), AS_OF).alias("discounts")).alias("a"))
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, want.collect())) and len(rows) > 100
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]


def test_rate_table_function(spark):
    i = Inputs(spark, SF)
    S.register_rating(spark, i.normalized, i.customers, i.rates, i.prior_rated)
    got = spark.sql("SELECT * FROM rate(DATE'2024-01-31')")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in RATED_CDR]
    want = RT.rate(i.normalized, i.customers, i.rates, i.prior_rated, USAGE_AS_OF)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # SQL around it: the date decides the loyalty discount
    early = spark.sql("SELECT count_if(discount_applied LIKE 'loyalty%') AS n FROM rate(DATE'2010-01-01')").first()["n"]
    assert early == 0


def test_other_rules(spark):
    from meterbill.schemas import TariffRules
    try:
        S.register_pricing(spark, TariffRules(peak_start_hour=0, peak_end_hour=24, peak_factor="3.00"))
        assert spark.sql("SELECT voice_cost(10, 1.0, 3, 1, NULL) AS x").first()["x"] == 30
    finally:
        S.register_pricing(spark)
