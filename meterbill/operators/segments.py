"""Customer segmentation (tertile scores) and spend distribution."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbill.schemas import SEGMENT_LABELS
from meterbill.session import scratch_path

TERTILES = [0.0, 1.0 / 3.0, 2.0 / 3.0, 1.0]


def quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> tuple[int, dict[str, list[float] | None]]:
    """Rows of ``df``, and exact linearly interpolated quantiles of each column
    (NULLs ignored; None for a column without values).

    All columns go through together as (column, value): a distributed group-by
    counts the values, one range partitioning orders them, and it is written
    once. The running count of a partition is offset by the totals of the ones
    before it (a window over a row for each column and partition), and only the
    rows at the needed ranks reach the driver: at most two a quantile. No task
    holds more than one range partition.
    """
    spark = df.sparkSession
    entries = [F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in cols]
    entries.append(F.struct(F.lit("").alias("k"), F.lit(0.0).alias("v")))              # counts the rows
    stacked = df.select(F.explode(F.array(*entries)).alias("e")).select("e.k", "e.v").where("v IS NOT NULL")
    counted = stacked.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = stored(counted.repartitionByRange(parts, "k", "v").withColumn("_pid", F.spark_partition_id()), "quantiles")
    totals = r.groupBy("k", "_pid").agg(F.sum("c").alias("t"))
    by_part = Window.partitionBy("k").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("t").over(Window.partitionBy("k"))
    places = [f(F.lit(p) * (F.col("_n") - 1)) for p in probs for f in (F.floor, F.ceil)]
    off = totals.select("k", "_pid", F.coalesce(F.sum("t").over(by_part), F.lit(0)).alias("_off"), n.alias("_n")).withColumn(
        "_ranks", F.array_distinct(F.array(*places)))
    w = Window.partitionBy("k", "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cum = (r.join(F.broadcast(off), ["k", "_pid"])        # a row for each column and range partition
           .withColumn("_hi", F.col("_off") + F.sum("c").over(w))
           .withColumn("_lo", F.col("_hi") - F.col("c")))
    hit = F.exists("_ranks", lambda k: (F.col("_lo") <= k) & (k < F.col("_hi")))
    rows = cum.where(hit).select("k", "v", "_lo", "_hi", "_n").collect()
    size = {x["k"]: x["_n"] for x in rows}
    found: dict[str, list[float] | None] = dict.fromkeys(cols)
    for c in (c for c in cols if c in size):
        found[c] = []
        for p in probs:
            pos = (size[c] - 1) * p
            lo, hi = (next(x["v"] for x in rows if x["k"] == c and x["_lo"] <= k < x["_hi"]) for k in (math.floor(pos), math.ceil(pos)))
            found[c].append(lo if pos == math.floor(pos) else lo + (hi - lo) * (pos - math.floor(pos)))
    return size.get("", 0), found


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float] | None:
    return quantiles(df, [col], probs)[1][col]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _score(col: str, edges: list[float] | None):
    """1..3 by right-closed tertile bins (lowest edge included). If two
    edges collide there are fewer than three bins and every row scores 2;
    NULL values score 2."""
    if edges is None or len(set(edges)) < 4:
        return F.lit(2)
    v = F.col(col).cast("double")
    return (F.when(v.isNull(), 2).when(v <= F.lit(edges[1]), 1).when(v <= F.lit(edges[2]), 2).otherwise(3))


def rfm_scores(df: DataFrame, frequency: str = "total_invoices", monetary: str = "total_spent") -> DataFrame:
    """Frequency and monetary scores over the population passed in (no
    recency term). Populations of 3 rows or fewer are not scored.

    The population is written once to the shared scratch folder: the edges and
    the scoring read it instead of re-running the pipeline that produced it.
    """
    df = stored(df, "population")
    n, e = quantiles(df, [frequency, monetary], TERTILES)
    if n <= 3:
        return df.select("*", *[F.lit(None).cast("int").alias(c)
                                for c in ("frequency_score", "monetary_score", "rfm_score")])
    f, m = _score(frequency, e[frequency]), _score(monetary, e[monetary])
    return df.select("*", f.cast("int").alias("frequency_score"), m.cast("int").alias("monetary_score")) \
        .withColumn("rfm_score", F.col("frequency_score") + F.col("monetary_score"))


def rfm_segments(scored: DataFrame) -> DataFrame:
    s = F.col("rfm_score")
    label = (F.when(s.isNull(), F.lit(None).cast("string"))
             .when(s >= 5, SEGMENT_LABELS[0]).when(s >= 4, SEGMENT_LABELS[1])
             .when(s >= 3, SEGMENT_LABELS[2]).otherwise(SEGMENT_LABELS[3]))
    return scored.withColumn("segment", label)


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.where(F.col("segment").isNotNull()).groupBy("segment").agg(F.count(F.lit(1)).alias("count"))


def segment_stats(rfm: DataFrame) -> DataFrame:
    return (rfm.where(F.col("segment").isNotNull()).groupBy("segment")
            .agg(F.count("customer_id").alias("customers"),
                 F.round(F.avg("total_spent"), 2).alias("mean_spent"),
                 F.round(F.sum("total_spent"), 2).alias("total_spent"),
                 F.round(F.avg("total_invoices"), 2).alias("mean_invoices")))


def spend_histogram(df: DataFrame, col: str = "total_spent", bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls in the last
    bin. Edges come from one aggregated row."""
    row = df.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bucket int, lower double, upper double, count bigint")
    width = (hi - lo) / bins if hi > lo else 0.0
    v = F.col(col).cast("double")
    b = F.lit(1) if width == 0.0 else F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins).cast("int") + 1,
                                                F.lit(bins))
    return (df.where(v.isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
            .select("bucket",
                    F.round(F.lit(lo) + (F.col("bucket") - 1) * F.lit(width), 4).alias("lower"),
                    F.round(F.lit(lo) + F.col("bucket") * F.lit(width), 4).alias("upper"),
                    "count"))
