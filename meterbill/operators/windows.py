"""Ordered-row metrics, paging and top-k.

The windows here have no PARTITION BY, so each runs in one task; they are
only applied to frames already aggregated to one row per day, month or
region (a few hundred rows at most), never to fact tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbill.functions.money import out_ratio
from meterbill.functions.regions import OTHER_REGION


def moving_average(df: DataFrame, col: str, order: str, rows: int = 7, name: str = "ma7") -> DataFrame:
    """Trailing mean over ``rows`` rows; NULL until the frame is full."""
    w = Window.orderBy(order).rowsBetween(-(rows - 1), 0)
    full = F.count(F.col(col)).over(w) == rows
    return df.withColumn(name, F.when(full, F.round(F.avg(F.col(col).cast("double")).over(w), 4)))


def growth(monthly: DataFrame) -> DataFrame:
    """Month-over-month growth (%) of revenue and invoice count; 0 for the
    first month. The last row is the headline figure."""
    w = Window.orderBy("month")
    prev_rev, prev_n = F.lag("total_revenue").over(w), F.lag("total_invoices").over(w)
    g = lambda cur, prev: F.coalesce(out_ratio(cur - prev, prev, 4, 100), F.lit(0.0))
    return monthly.select("month", "total_revenue", "total_invoices",
                          g(F.col("total_revenue"), prev_rev).alias("revenue_growth"),
                          g(F.col("total_invoices"), prev_n).alias("invoice_growth"))


def latest(monthly: DataFrame, cols: list[str]) -> DataFrame:
    """Values of the newest month as one row (max_by, no sort)."""
    return monthly.agg(F.max("month").alias("month"),
                       *[F.max_by(c, "month").alias(c) for c in cols])


def arpu(monthly: DataFrame, customer_metrics: DataFrame) -> DataFrame:
    """Newest month revenue / active customers. The two one-row frames are
    stacked and folded, not joined."""
    last = latest(monthly, ["total_revenue"]).withColumn("active_customers", F.lit(None).cast("bigint"))
    m = customer_metrics.select(F.lit(None).cast("date").alias("month"),
                                F.lit(None).cast("double").alias("total_revenue"), "active_customers")
    both = last.unionByName(m).agg(F.max("month").alias("month"), F.max("total_revenue").alias("total_revenue"),
                                   F.max("active_customers").alias("active_customers"))
    return both.select("month", "total_revenue", "active_customers",
                       F.coalesce(out_ratio(F.col("total_revenue"), F.col("active_customers")), F.lit(0.0))
                        .alias("arpu"))


def window_total(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.round(F.sum("total_revenue"), 2).alias("window_revenue"),
                       F.sum("total_invoices").alias("window_invoices"))


def targets(monthly: DataFrame, rate: float = 0.1) -> DataFrame:
    """first month's revenue x (1+rate)^i; only when there are 2+ months."""
    w = Window.orderBy("month")
    wall = Window.partitionBy()
    i = F.row_number().over(w) - 1
    base = F.first("total_revenue").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.round(base * F.pow(F.lit(1.0 + rate), i), 4)
    return monthly.select("month", "total_revenue",
                          F.when(F.count(F.lit(1)).over(wall) > 1, target).alias("target"))


def overview(monthly: DataFrame, customer_metrics: DataFrame) -> DataFrame:
    """Headline totals: revenue, invoices, average (0 if none), active customers."""
    a = monthly.agg(F.sum("total_revenue").alias("total_revenue"),
                    F.sum("total_invoices").alias("total_invoices")) \
        .withColumn("active_customers", F.lit(None).cast("bigint"))
    b = customer_metrics.select(F.lit(None).cast("double").alias("total_revenue"),
                                F.lit(None).cast("bigint").alias("total_invoices"), "active_customers")
    t = a.unionByName(b).agg(*[F.max(c).alias(c) for c in ["total_revenue", "total_invoices", "active_customers"]])
    return t.select(F.round("total_revenue", 2).alias("total_revenue"),
                    F.coalesce("total_invoices", F.lit(0)).cast("bigint").alias("total_invoices"),
                    F.coalesce(out_ratio(F.col("total_revenue"), F.col("total_invoices")), F.lit(0.0))
                     .alias("avg_invoice"),
                    "active_customers")


def page(df: DataFrame, order: list[Column], page_no: int, size: int = 5) -> DataFrame:
    """Rows of page ``page_no`` (1-based) under a total order (top-k with an
    offset, not a numbered copy of the whole frame)."""
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size)


def page_count(df: DataFrame, size: int = 5) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_items")) \
        .withColumn("total_pages", F.ceil(F.col("total_items") / F.lit(size)).cast("bigint"))


def top_k(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(col), F.asc(tie)).limit(n)


def sample_head(df: DataFrame, n: int = 50) -> DataFrame:
    return df.limit(n)


def top_with_rest(regions: DataFrame, n: int = 6, value: str = "total_revenue",
                  key: str = "region") -> DataFrame:
    """The n largest rows plus one 'Autres' row carrying the rest (only if
    the rest is > 0). Ranking is by position, so a mapped region that is
    itself called 'Autres' stays a separate row."""
    w = Window.orderBy(F.desc(value), F.asc(key))
    ranked = regions.select(key, value, F.row_number().over(w).alias("rank"))
    top = ranked.where(F.col("rank") <= n)
    rest = (ranked.where(F.col("rank") > n)
            .agg(F.round(F.sum(value), 2).alias(value))
            .where(F.col(value) > 0)
            .select(F.lit(OTHER_REGION).alias(key), value, F.lit(n + 1).alias("rank")))
    return top.unionByName(rest)
