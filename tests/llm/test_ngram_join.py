import random
import re

import pytest

from conftest import table
from meterbill.llm import ngram_join as N

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, k):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset([tuple(w)] if 0 < len(w) < k else (tuple(w[i:i + k]) for i in range(len(w) - k + 1)))


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def near_copies():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [random.choice(vocabulary) for _ in range(n)]
    passage, bases = prose(60), [prose(random.choice((2, 5, 30, 120, 400))) for _ in range(20)]
    docs = []
    for d in range(150):
        w = list(random.choice(bases)) if random.random() < 0.8 else passage + prose(30)
        for _ in range(random.choice((0, 0, 1, 2, 6))):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        docs.append((d * 7 % 1000, random.choice((" ", "\n", "  ")).join(w)))
    return docs


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[2] or 0)


@pytest.mark.parametrize("k,num,small", [(3, 90, False), (5, 80, False), (3, 90, True)])
def test_equals_brute_force(spark, monkeypatch, odd_texts, k, num, small):
    if small:                          # everything dealt out in chunks, nothing broadcast, no counted shingles
        monkeypatch.setattr(N, "_TASK_SHINGLES", 300)
        monkeypatch.setattr(N, "MAX_BROADCAST_BYTES", 0)
        monkeypatch.setattr(N, "MAX_COUNTED", 3)
    rows = near_copies() + [(None if i is None else i + 5000, t) for i, t in odd_texts]
    got = [tuple(r) for r in N.link_documents(spark, table(spark, rows).repartition(3), k, num, 100)
           .select("doc_id", "n_shingles", "component_id").collect()]
    want = brute(rows, k, num, 100)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({r[2] for r in got}) < len(rows) - 30


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, N.op10_ngram_join(spark, sf).collect())) == sorted(brute(rows, 3, 90, 100))


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (2, "other words in here now"), (4, ""), (5, None), (4, "")]
    docs = table(spark, rows).withColumnRenamed("lang", "keep_id").withColumnRenamed("source", "all_copies")
    out = N.keep_one(spark, docs)
    assert out.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert [r for r in kept if r[1]] == [(1, "A b c d e f"), (2, "other words in here now")]
    assert N.keep_one(spark, docs.limit(0)).count() == 0


def test_keep_one_of_each_component_whatever_its_ids(spark):
    """Unrelated rows without ids, one id with two texts, and real copies of them."""
    rows = [(None, "first text that has no id"), (None, "second and quite different words"), (None, "First text that has no id"),
            (7, "one text of the id seven"), (7, "something else under that same id"), (8, "One text of the id seven"),
            (9, "second and quite different words")]
    got = sorted(((r["doc_id"], r["text"]) for r in N.keep_one(spark, table(spark, rows)).collect()), key=str)
    assert len(got) == 4
    assert [(i, t.lower()) for i, t in got] == sorted([
        (None, "first text that has no id"), (9, "second and quite different words"),
        (7, "one text of the id seven"), (7, "something else under that same id")], key=str)


def test_divide_skip_spans_all_components():
    import numpy as np
    random.seed(8)
    for _ in range(40):
        base = random.sample(range(10_000), 60)
        sets = []
        for _ in range(25):
            s = set(base[:random.choice((20, 58, 60))])
            for _ in range(random.choice((0, 1, 2, 5))):
                s.add(random.randrange(10_000))
            sets.append(np.array(sorted(s)))
        links = N.divide_skip(90, 100)(sets)
        up = list(range(25))

        def root(u, i):
            while u[i] != i:
                i = u[i]
            return i
        for i, j in links:
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            assert 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both)
            up[max(root(up, i), root(up, j))] = min(root(up, i), root(up, j))
        full = list(range(25))
        for i in range(25):
            for j in range(i):
                both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
                if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                    full[max(root(full, i), root(full, j))] = min(root(full, i), root(full, j))
        assert [root(up, i) for i in range(25)] == [root(full, i) for i in range(25)]
