import itertools

import numpy as np
from pyspark.sql import functions as F

from meterbill.llm import curves as C


def test_hilbert_curve_visits_neighbours():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        keys = C.hilbert_key(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, queries, k):
    out = {}
    for q in queries:
        x = np.array(q[1], float)
        found = [(-float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), v[0]) for v in rows if v is not q
                 for y in [np.array(v[1], float)]]
        out[q[0]] = sorted(found)[:k]
    return out


def test_recall_on_embeddings(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = C.op9_nearest(spark, sf).collect()
    assert len(got) == 5 * len(want)
    hits = sum(r["vec_id"] in [v for _, v in want[r["query_id"]]] for r in got)
    assert hits / len(got) >= 0.9
    for q in want:
        mine = sorted((r["rank"], r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and all(a[1] >= b[1] for a, b in zip(mine, mine[1:]))


def test_narrow_windows_still_reach_recall(spark):
    """Small blocks, so that most rows are outside a query's windows."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.3 * rng.normal(size=16)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = [r for r in rows if r[0] % 100 == 0]
    want = brute(rows, queries, 5)
    got = C.nearest(spark, df, F.col("vec_id") % 100 == 0, block=32, window=0.01, curves=12).collect()
    hits = sum(r["vec_id"] in [v for _, v in want[r["query_id"]]] for r in got)
    assert len(got) == 150 and hits / 150 >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [2.0, 0.0]), (1, [0.0, 3.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [1.0, None]), (6, [inf, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, row string")
    got = sorted(tuple(r) for r in C.nearest(spark, df, F.col("vec_id") % 50 == 0, k=5).collect())
    fifty = [(50, 1, 0, 1.0), (50, 2, 0, 1.0), (50, 3, 1, 0.0), (50, 4, 9, -1.0)]
    assert [g for g in got if g[0] == 50] == fifty
    zero = [(0, 1, 0, 1.0), (0, 2, 50, 1.0), (0, 3, 1, 0.0), (0, 4, 9, -1.0)]
    assert [g for g in got if g[0] == 0] == sorted(zero * 2)
    assert C.nearest(spark, df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
