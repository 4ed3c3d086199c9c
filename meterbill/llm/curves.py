"""Approximate nearest neighbours on shifted space-filling curves.

Unit vectors are projected to a few dimensions, once for each of several
random projections, shifted, and put in the order of a Hilbert curve. Rows
near a query on a curve are its candidates: each curve is range-partitioned and
cut into blocks of equal length, a query visits the blocks within its window
on every curve, candidates are compared by exact cosine there, and the best of
all blocks are merged.

The window is a share of all rows, so recall does not fall as the table grows;
on vectors without structure (independent components) that share decides
recall, and the curves together visit most rows. ``recall`` compares with brute
force on a set of queries.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those of another length than the most common
one (ties: the shorter). Rows with equal ``vec_id`` are different candidates;
a query never finds its own row. Equal scores go to the smaller ``vec_id``.
With fewer candidates than ``k`` all are returned. Empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

CURVES = 24
DIMENSIONS = 8
BITS = 7
WINDOW = 0.02             # share of all rows before and after a query on a curve
BLOCK = 1024
SEED = 11


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (n x dimensions) with ``bits`` bits
    a coordinate: the rotations of each level are undone from the coarsest one
    down, a Gray code follows, and the bits of all coordinates are interleaved."""
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(len(x)):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(level)) & one, (one << np.uint64(level)) - one, np.uint64(0))
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | (((c ^ flip) >> np.uint64(level)) & one)
    return key


def curve_keys(unit: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS,
               seed: int = SEED) -> np.ndarray:
    """Keys (curves x rows) of unit vectors. Coordinates go through the logistic
    curve that fits a unit vector's component, so cells are about equally full."""
    d = unit.shape[1]
    p = min(dimensions, d)
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(curves):
        basis = np.linalg.qr(rng.normal(size=(d, p)))[0]
        shift = rng.uniform(0, 1, p)
        y = 1 / (1 + np.exp(-1.702 * np.sqrt(d) * (unit @ basis)))
        cells = ((y + shift) / 2 * (1 << bits)).astype(np.int64)
        out.append(hilbert_key(np.minimum(cells, (1 << bits) - 1), bits))
    return np.array(out).reshape(curves, -1)


def _stack(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _on_curves(curves: int, dimensions: int, bits: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _stack(batch.column("embedding"))
            keys = curve_keys(x / np.linalg.norm(x, axis=1, keepdims=True), curves, dimensions, bits, seed)
            for c in range(curves):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(keys[c].view(np.int64)), batch.column("row"),
                     batch.column("vec_id"), batch.column("embedding")], ["curve", "place", "row", "vec_id", "embedding"])
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, embedding`` of the vectors that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select("vec_id", e.cast("array<double>").alias("embedding")).where(e.isNotNull() & (F.size(e) > 0))
            .where(F.coalesce(finite, F.lit(False))).where(F.exists(e, lambda x: x * x > 0)))
    most = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(most), F.size("embedding") == F.col("d")).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")


def _best(k: int) -> Callable:
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "row", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not block.num_rows or not asked.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        x, q = _stack(block.column("embedding").combine_chunks()), _stack(asked.column("embedding").combine_chunks())
        nx, nq = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
        row, vec_id = block.column("row").to_numpy(), block.column("vec_id").to_numpy()
        near = (q / nq[:, None]) @ (x / nx[:, None]).T
        near[asked.column("row").to_numpy()[:, None] == row[None, :]] = -np.inf
        keep = min(k + 3, len(x))              # rounding must not cost a neighbour
        top = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
        out: list[list] = [[] for _ in names]
        for i in range(len(q)):
            # all that tie with the last of the best are looked at
            at = np.flatnonzero(near[i] >= near[i, top[i]].min() - 1e-12) if np.isfinite(near[i, top[i]]).all() else top[i]
            at = at[np.isfinite(near[i, at])]
            score = np.array([np.dot(q[i], x[j]) / (nq[i] * nx[j]) for j in at])
            for j in np.lexsort((vec_id[at], -score))[:k]:
                for column, value in zip(out, (asked.column("row")[i].as_py(), asked.column("vec_id")[i].as_py(),
                                               int(row[at[j]]), int(vec_id[at[j]]), float(score[j]))):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names)
    return run


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, curves: int = CURVES,
            dimensions: int = DIMENSIONS, bits: int = BITS, window: float = WINDOW, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each row
    where ``is_query`` (an expression of vec_id)."""
    scratch = Scratch(spark, "curves")
    rows = scratch.write(usable(vectors.where(F.col("vec_id").isNotNull())), "rows")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    on_curves = rows.mapInArrow(_on_curves(curves, dimensions, bits, SEED),
                                "curve int, place long, row long, vec_id long, embedding array<double>")
    order = ["curve", "place", "row"]
    placed = scratch.write(on_curves.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "curve", "row", "vec_id", "embedding", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at")), "placed")
    # rank on a curve: counted within a range partition, after the totals of earlier ones
    sums = placed.groupBy("curve", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("curve", "part", (F.coalesce(F.sum("n").over(along), F.lit(0)) - F.col("first")).alias("add"))
    n = rows.count()
    reach = int(np.ceil(window * n))
    ranked = placed.join(F.broadcast(sums), ["curve", "part"]).select(       # a row for each curve and partition
        "curve", F.floor((F.col("at") + F.col("add")) / block).alias("block"), (F.col("at") + F.col("add")).alias("rank"),
        "row", "vec_id", "embedding")
    last = max(0, n - 1) // block
    visits = ranked.where(is_query).select(*[F.col(c).alias(c) for c in ("curve", "row", "vec_id", "embedding")], F.explode(F.sequence(
        F.greatest(F.lit(0), F.floor((F.col("rank") - reach) / block)),
        F.least(F.lit(last), F.floor((F.col("rank") + reach) / block)))).alias("block"))
    found = (ranked.drop("rank").groupBy("curve", "block").cogroup(visits.groupBy("curve", "block"))
             .applyInArrow(_best(k), "query_row long, query_id long, row long, vec_id long, score double"))
    merged = found.groupBy("query_row", "row").agg(
        F.first("query_id").alias("query_id"), F.first("vec_id").alias("vec_id"), F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(spark, vectors, F.col("vec_id") % 50 == 0)
