import hashlib
from collections import Counter

import numpy as np
import pytest

from meterbill.llm import sharding as S

SHARDS = [f"s{i}" for i in range(7)]


def number(t):
    return int(hashlib.md5(t.encode()).hexdigest()[:15], 16)


def brute_table(shards, size):
    """Turns, with each shard's whole preference list written out."""
    lists = {s: [(number(f"offset:{s}") % size + j * (number(f"skip:{s}") % (size - 1) + 1)) % size for j in range(size)]
             for s in shards}
    owner = {}
    while len(owner) < size:
        for s in shards:
            if len(owner) < size:
                owner[next(x for x in lists[s] if x not in owner)] = s
    return [owner[i] for i in range(size)]


def test_table_equals_brute_force():
    for n, size in ((1, 2), (3, 11), (7, 101)):
        assert [SHARDS[i] for i in S.lookup_table(SHARDS[:n], size)] == brute_table(SHARDS[:n], size)


def test_table_is_even_and_stable():
    full = S.lookup_table(SHARDS, 1009)
    sizes = Counter(full.tolist())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = S.lookup_table(SHARDS[:-1], 1009)
    stayed = np.mean([SHARDS[a] == SHARDS[b] for a, b in zip(full, fewer) if SHARDS[a] != "s6"])
    assert stayed > 0.8


def test_bad_tables_are_refused():
    for shards, size in ((SHARDS, 100), ([], 101), (["a", "a"], 101), (SHARDS, 5)):
        with pytest.raises(ValueError):
            S.lookup_table(shards, size)


def test_placement(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (10**15, "d")], "doc_id long, shard string")
    got = {r["doc_id"]: r for r in S.assign_shards(spark, df, "doc_id", SHARDS, 101).collect()}
    want = brute_table(SHARDS, 101)
    for key, row in got.items():
        slot = number("" if key is None else str(key)) % 101
        assert (row["slot"], row["shard"]) == (slot, want[slot])
    assert S.assign_shards(spark, df.limit(0), "doc_id").count() == 0


def test_query_places_every_document(spark):
    out = S.op7_sharding(spark, "/root/testdata/sf0.001")
    want = S.lookup_table([f"shard-{i:05d}" for i in range(S.N_SHARDS)])
    for r in out.collect():
        assert r["shard"] == f"shard-{want[number(str(r['doc_id'])) % S.TABLE_SIZE]:05d}"
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_written_shards(spark, tmp_path):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    S.write_shards(S.assign_shards(spark, df, "doc_id", SHARDS, 101), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 500 and back.select("shard").distinct().count() == 7
