import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from conftest import table
from meterbill.llm import resampling as R

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    return len(words), [zlib.crc32(b" ".join(words[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, least=20):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for total, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for b in features(x)[1]:
                total[b] += 1
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (float(s.sum()) + 10000) / ((float(s[b]) + 1) * (float(t.sum()) + 10000))))
            for b in range(10000)]
    out = []
    for doc_id, x in rows:
        n, found = features(x)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=key)


def key(r):
    return (r[0] is not None, r[0] or 0, r[1:4], r[4] or 0)


def test_crc_matrices():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 9000, dtype=np.uint8)
    begin = rng.integers(0, 7000, 3000)
    size = np.concatenate([rng.integers(0, 40, 2990), rng.integers(900, 2000, 10)])
    assert R.crc32s(buf, begin, size).tolist() == [zlib.crc32(buf[b:b + n].tobytes()) for b, n in zip(begin, size)]
    assert len(R.crc32s(buf, begin[:0], size[:0])) == 0


def test_features_of_batches():
    random.seed(1)
    parts = [" ", " ", "\n", "a", "B", "é", "1", ".", "'s", "漢", "word", "the", "The", "_"]
    for _ in range(150):
        texts = ["".join(random.choices(parts, k=random.randint(0, 20))) for _ in range(random.randint(0, 20))] + random.choice(
            [[], [None], ["x" * 3000 + " y"]])
        counts, found = R.feature_buckets(pa.array(texts, pa.string()))
        got = [[] for _ in texts]
        for owner, bucket in found:
            for i, b in zip(owner.tolist(), bucket.tolist()):
                got[i].append(b)
        assert list(zip(counts.tolist(), got)) == [features(t) for t in texts]


def test_query_on_odd_texts(spark, folder, odd_texts):
    random.seed(6)
    words = ["the", "of", "Unit", "é", "漢字", "x1", "2024", "and"]
    rows = odd_texts + [(100 + i, " ".join(random.choices(words, k=random.randint(15, 60)))) for i in range(300)]
    rows += rows[-20:] + [(None, " ".join(words * 4))] * 2
    target = ["the unit of the unit " * 5, None, "", "2024 and 2024"]
    path = folder(documents=table(spark, rows).repartition(6),
                  benchmark=spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string"))
    got = sorted((tuple(r) for r in R.op11_resampling(spark, path).collect()), key=key)
    want = brute(rows, target)
    # of rows equal in all but the rank, which one has which rank is open
    assert got == want and sum(r[4] is not None for r in got) >= 10


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted((tuple(r) for r in R.op11_resampling(spark, sf).collect()), key=key) == brute(rows, target)


def test_empty_tables_and_other_columns(spark):
    docs = table(spark, [(i, "some words that make a text of twenty words " * 4) for i in range(40)]).withColumnRenamed("lang", "rank").withColumnRenamed(
        "source", "n_words")
    target = spark.createDataFrame([], "item_id string, text string")
    out = R.resample(spark, docs, target).collect()
    assert len(out) == 40 and sorted(r["rank"] for r in out if r["rank"]) == [1, 2]
    assert R.resample(spark, docs.limit(0), target).count() == 0
