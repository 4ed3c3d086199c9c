import datetime as dt

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterbill.functions.calendar import add_months, month_diff, whole_years
from meterbill.functions.regions import OTHER_REGION, REGION_MAPPING, UNDEFINED_REGION, region_of, region_sql
from meterbill.operators import segments as S
from meterbill.operators import windows as W


def probe(city):
    """Three-step lookup of the dashboard: as given, title case, upper case."""
    if city is None:
        return UNDEFINED_REGION
    c = str(city).strip()
    for k in (c, c.title(), c.upper()):
        if k in REGION_MAPPING:
            return REGION_MAPPING[k]
    return OTHER_REGION


def test_region_lookup_matches_three_step_probe(spark):
    variants = set()
    for k in REGION_MAPPING:
        for v in (k, k.lower(), k.upper(), k.title(), k.swapcase(), f"  {k} ", f"\t{k.lower()}"):
            variants.add(v)
    variants |= {None, "PARIS", "", "  ", "Tan-tan", "tan-tan", "salé", "SALÉ", "fès"}
    vals = sorted(variants, key=lambda x: (x is None, x or ""))
    df = spark.createDataFrame([(v,) for v in vals], "city string")
    got = dict(df.select("city", region_of(F.col("city")).alias("r")).collect())
    for v in vals:
        assert got[v] == probe(v), v
    # the SQL twin used by the oracle agrees too
    con = duckdb.connect()
    con.execute("CREATE TABLE t(city VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    sql = dict(con.execute(f"SELECT city, {region_sql('city')} FROM t").fetchall())
    for v in vals:
        assert sql[v] == got[v], v


def test_whole_years_matches_sql_age(spark):
    pairs = [(dt.date(2023, 2, 28), dt.date(2020, 2, 29)), (dt.date(2024, 2, 29), dt.date(2020, 2, 29)),
             (dt.date(2024, 1, 31), dt.date(2023, 1, 31)), (dt.date(2024, 1, 30), dt.date(2023, 1, 31)),
             (dt.date(2024, 3, 1), dt.date(2023, 2, 28)), (dt.date(2001, 8, 1), dt.date(1995, 8, 2))]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(whole_years(F.col("a"), F.col("b"))).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT date_part('year', age(?::DATE, ?::DATE))", [a, b]).fetchone()[0] for a, b in pairs]
    assert got == want
    md = [r[0] for r in spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2023, 1, 1)),
                                               (dt.date(2024, 1, 1), dt.date(2022, 12, 31))], "a date, b date")
          .select(month_diff(F.col("a"), F.col("b"))).collect()]
    assert md == [12, 13]
    assert add_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)


def exact_edges(values):
    """Tertile edges with linear interpolation, in exact arithmetic."""
    from fractions import Fraction
    import math
    v = sorted(values)
    n = len(v)
    out = []
    for k in range(4):
        pos = Fraction((n - 1) * k, 3)
        lo = math.floor(pos)
        hi = min(lo + 1, n - 1)
        out.append(v[lo] + (v[hi] - v[lo]) * (pos - lo))
    return out


def qcut_scores(values):
    """qcut into three labelled bins (right-closed, lowest included); when
    edges collide the labels cannot be applied and every row scores 2."""
    e = exact_edges(values)
    if len(set(e)) < 4:
        return [2] * len(values)
    return [1 if x <= e[1] else 2 if x <= e[2] else 3 for x in values]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=9), min_size=4, max_size=16))
def test_tertile_scores_follow_qcut(spark, values):
    df = spark.createDataFrame([(i, float(v), v) for i, v in enumerate(values)],
                               "customer_id int, total_spent double, total_invoices int")
    got = [r["frequency_score"] for r in S.rfm_scores(df).orderBy("customer_id").collect()]
    assert got == qcut_scores(values)
    # where pandas computes the edges without rounding error it agrees too
    s = pd.Series(values, dtype="float64")
    if [float(x) for x in exact_edges(values)] == s.quantile([0, 1 / 3, 2 / 3, 1]).tolist():
        try:
            want = [int(x) for x in pd.qcut(s, 3, labels=[1, 2, 3], duplicates="drop")]
        except ValueError:
            want = [2] * len(values)
        assert got == want


def test_rfm_small_population_not_scored(spark):
    df = spark.createDataFrame([(1, 5.0, 2), (2, 6.0, 3), (3, 7.0, 4)],
                               "customer_id int, total_spent double, total_invoices int")
    rows = S.rfm_segments(S.rfm_scores(df)).collect()
    assert all(r["segment"] is None and r["rfm_score"] is None for r in rows)


def test_segments_labels(spark):
    df = spark.createDataFrame([(s,) for s in (6, 5, 4, 3, 2)], "rfm_score int")
    got = [r[0] for r in S.rfm_segments(df).select("segment").collect()]
    assert got == ["🌟 Champions", "🌟 Champions", "💎 Loyaux", "📈 Potentiel", "🚨 À risque"]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 5, 9.99, 10)], "total_spent double")
    got = {r["bucket"]: r["count"] for r in S.spend_histogram(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 1, 10: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "total_spent double")
    assert [tuple(r) for r in S.spend_histogram(same).collect()] == [(1, 3.0, 3.0, 2)]


def test_moving_average_needs_seven_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in range(1, 10)], "date date, v double")
    got = [r["ma7"] for r in W.moving_average(df, "v", "date").orderBy("date").collect()]
    assert got[:6] == [None] * 6 and got[6:] == [4.0, 5.0, 6.0]


def test_growth_and_targets(spark):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), 100.0, 10), (dt.date(2024, 2, 1), 150.0, 12),
                               (dt.date(2024, 3, 1), 120.0, 12)], "month date, total_revenue double, total_invoices long")
    g = W.growth(m).orderBy("month").collect()
    assert [r["revenue_growth"] for r in g] == [0.0, 50.0, -20.0]
    assert [r["invoice_growth"] for r in g] == [0.0, 20.0, 0.0]
    t = [r["target"] for r in W.targets(m).orderBy("month").collect()]
    assert t == [100.0, 110.0, 121.0]
    one = m.limit(1)
    assert W.targets(one).collect()[0]["target"] is None


def test_top_with_rest_keeps_autres_region_separate(spark):
    rows = [(f"R{i}", float(100 - i)) for i in range(8)] + [(OTHER_REGION, 5.0)]
    df = spark.createDataFrame(rows, "region string, total_revenue double")
    out = W.top_with_rest(df, 6).collect()
    assert len(out) == 7
    rest = [r for r in out if r["rank"] == 7][0]
    assert rest["region"] == OTHER_REGION and rest["total_revenue"] == 94.0 + 93.0 + 5.0


def test_page(spark):
    df = spark.createDataFrame([(i,) for i in range(12)], "k int")
    assert [r[0] for r in W.page(df, [F.col("k")], 3, 5).collect()] == [10, 11]
    assert W.page_count(df, 5).collect()[0]["total_pages"] == 3


def test_exact_quantiles(spark):
    import random
    rnd = random.Random(5)
    vals = [float(rnd.randint(0, 400)) for _ in range(3000)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    import numpy as np
    clean = sorted(v for v in vals if v is not None)
    for q, e in zip(S.TERTILES, S.exact_quantiles(df, "x", S.TERTILES)):
        pos = (len(clean) - 1) * q
        lo, hi = int(np.floor(pos)), int(np.ceil(pos))
        assert abs(e - (clean[lo] + (clean[hi] - clean[lo]) * (pos - lo))) < 1e-9
    assert S.exact_quantiles(df.where("x IS NULL"), "x", S.TERTILES) is None
