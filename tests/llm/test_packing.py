import itertools
import random

import numpy as np

from conftest import table
from meterbill.llm import packing as P


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_bounds_are_optimal():
    random.seed(2)
    for _ in range(60):
        lengths = sorted(random.sample(range(1, 60), random.randint(1, 9)))
        counts = [random.randint(1, 50) for _ in lengths]
        k = random.randint(1, 5)
        bounds = P.optimal_bounds(np.array(lengths), np.array(counts), k)
        best = min(padding(lengths, counts, (*c, lengths[-1])) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1))
        assert len(bounds) <= k and padding(lengths, counts, bounds) == best
    assert P.optimal_bounds(np.array([]), np.array([]), 3) == []


def brute(rows, max_len, n_buckets, budget):
    pieces = []
    for doc_id, n in rows:
        for p in range((n - 1) // max_len + 1):
            pieces.append((doc_id, p, min(max_len, n - p * max_len)))
    lengths, counts = np.unique([x[2] for x in pieces], return_counts=True)
    bounds = P.optimal_bounds(lengths, counts, n_buckets)
    seen, out = {}, []
    for doc_id, p, n in pieces:
        b = next(i for i, x in enumerate(bounds) if x >= n)
        rank = seen[b] = seen.get(b, -1) + 1
        per = max(1, budget // bounds[b])
        out.append((doc_id, p, n, b, bounds[b], rank // per, rank % per))
    return out


def test_batches_equal_brute_force(spark):
    random.seed(4)
    rows = [(i, "x" * random.choice((0, 3, 50, 700, 5000))) for i in range(300)]
    got = sorted(map(tuple, P.pack(spark, table(spark, rows).repartition(5), max_len=1000, n_buckets=4, token_budget=4000).collect()))
    assert got == sorted(brute([(i, len(t) + 1) for i, t in rows], 1000, 4, 4000))


def test_odd_texts_keep_every_token(spark, folder, odd_texts):
    out = P.op6_packing(spark, folder(documents=table(spark, odd_texts))).collect()
    assert sum(r["length"] for r in out) == sum(len((t or "").encode()) + 1 for _, t in odd_texts)
    places = [(r["bucket"], r["batch"], r["slot"]) for r in out]
    assert len(set(places)) == len(places) and all(r["length"] <= r["bound"] <= P.MAX_LEN for r in out)
    for b in {r["bucket"] for r in out}:
        per = max(1, P.TOKEN_BUDGET // next(r["bound"] for r in out if r["bucket"] == b))
        ranks = sorted(r["batch"] * per + r["slot"] for r in out if r["bucket"] == b)
        assert ranks == list(range(len(ranks)))


def test_empty_table(spark, folder):
    assert P.op6_packing(spark, folder(documents=table(spark, []))).count() == 0
