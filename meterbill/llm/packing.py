"""Packing into optimal length buckets.

Lengths are counted in one global histogram; a dynamic program over it picks
the ``n_buckets`` upper bounds that leave the least padding when every
sequence is padded to its bucket's bound. In a bucket of bound ``b`` batches
hold ``token_budget // b`` sequences.

A document longer than ``max_len`` tokens is cut into pieces of ``max_len``
and a rest, so no token is lost and the histogram has at most ``max_len``
rows, whatever the data: that bounds what the driver gets. The exact order of
sequences in a bucket (by ``doc_id``, then piece) is counted from range
partitions and their totals; no bucket goes through one task.

Length of a text: its UTF-8 bytes plus an end token (a byte-level
vocabulary), or a column the caller names.

Defined cases: null text counts as empty (length 1: the end token). A null
``doc_id`` comes first. Rows with equal ``doc_id`` are all packed; their order
among themselves is by text hash, and identical rows are interchangeable. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, text_key

MAX_LEN = 8192
N_BUCKETS = 16
TOKEN_BUDGET = 65536


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds, ascending, of at most ``n_buckets`` buckets with the least
    total padding. The cost of a bucket that ends at ``j`` and starts after
    ``i`` is ``len[j] * (N[j] - N[i]) - (S[j] - S[i])``; its best split points
    do not decrease in ``j``, so each layer is found by divide and conquer."""
    order = np.argsort(lengths)
    length, count = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    m = len(length)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum(count)])
    k = min(n_buckets, m)
    best = np.concatenate([[0], np.full(m, np.iinfo(np.int64).max // 4)])   # padded tokens of the first j lengths
    splits = np.zeros((k + 1, m + 1), np.int64)
    for layer in range(1, k + 1):
        new = np.full(m + 1, np.iinfo(np.int64).max // 4)
        new[0] = 0
        todo = [(1, m, 0, m - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            i = np.arange(lo, min(hi, j - 1) + 1)
            total = best[i] + length[j - 1] * (n[j] - n[i])
            at = int(np.argmin(total))
            new[j], splits[layer, j] = total[at], i[at]
            todo += [(a, j - 1, lo, int(i[at])), (j + 1, b, int(i[at]), hi)]
        best = new
    bounds, j = [], m
    for layer in range(k, 0, -1):
        if j == 0:
            break
        bounds.append(int(length[j - 1]))
        j = int(splits[layer, j])
    return bounds[::-1]


def byte_tokens(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def pack(spark: SparkSession, docs: DataFrame, n_tokens: Column | None = None, max_len: int = MAX_LEN,
         n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row a sequence: ``doc_id, piece, length, bucket, bound, batch, slot``."""
    scratch = Scratch(spark, "pack")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", text_key(F.coalesce("text", F.lit(""))).alias("tie"),
                       (byte_tokens(F.col("text")) if n_tokens is None else n_tokens).alias("total"))
    pieces = (rows.withColumn("row", F.monotonically_increasing_id())
              .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / max_len))))
              .withColumn("length", F.least(F.lit(max_len).cast("long"), F.col("total") - F.col("piece") * max_len)))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row", "piece"]
    dealt = pieces.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = scratch.write(dealt.select("doc_id", "piece", "length", F.spark_partition_id().alias("part"),
                                        F.monotonically_increasing_id().alias("place")), "pieces")

    histogram = pieces.groupBy("length").count().toPandas()                 # at most max_len rows
    bounds = optimal_bounds(histogram["length"].to_numpy(), histogram["count"].to_numpy(), n_buckets)
    if not bounds:
        return spark.createDataFrame([], "doc_id long, piece long, length long, bucket int, bound long, batch long, slot long")
    bucket = F.lit(len(bounds) - 1)
    for b in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("length") <= bounds[b], b).otherwise(bucket)
    bucketed = pieces.withColumn("bucket", bucket)
    # places of a range partition keep their order; in a bucket they are counted
    # within (part, bucket) groups, whose size the ranges bound
    local = F.row_number().over(Window.partitionBy("part", "bucket").orderBy("place")) - 1
    totals = bucketed.groupBy("part", "bucket").count()                     # parts x buckets rows
    before = F.coalesce(F.sum("count").over(
        Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("part", "bucket", before.alias("before"))
    bound = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1)
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / F.col("bound")))
    return (bucketed.withColumn("rank", local).join(starts, ["part", "bucket"])
            .withColumn("rank", F.col("rank") + F.col("before")).withColumn("bound", bound)
            .select("doc_id", "piece", "length", "bucket", "bound",
                    F.floor(F.col("rank") / per_batch).alias("batch"), (F.col("rank") % per_batch).alias("slot")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
