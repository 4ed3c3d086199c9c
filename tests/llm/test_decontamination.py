import hashlib
import random
import re

import duckdb
import pytest

from conftest import table
from meterbill.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *map(str, r[1:]))


def run(spark, docs, items, report=None):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return (report or D.contamination)(spark, table(spark, docs), bench)


def cases():
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ñandú", "Ab"]
    prose = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, prose(random.choice((3, 8, 10, 11, 25)))) for i in range(20)]
    items += [(100, items[0][1].upper()), (101, ""), (102, None), (103, "one"), (None, prose(12)), (5, items[5][1])]
    docs = [(i, prose(random.randint(0, 60))) for i in range(60)]
    for i in range(40):
        a, b = random.choice(items)[1] or "", random.choice(items)[1] or ""
        docs.append((100 + i, f"{prose(5)}, {a}! {prose(random.randint(0, 4))} {b}\n{a}"))
    return docs, items


@pytest.mark.parametrize("most", [D.MAX_BROADCAST_WINDOWS, 60])
def test_equals_brute_force(spark, monkeypatch, odd_texts, most):
    monkeypatch.setattr(D, "MAX_BROADCAST_WINDOWS", most)
    docs, items = cases()
    docs = docs + odd_texts
    got = [tuple(r) for r in run(spark, docs, items).collect()]
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)
    assert sum(r[5] for r in got) > 30


def test_empty_tables(spark):
    docs, items = cases()
    assert run(spark, [], items).count() == 0
    assert not any(r["contaminated"] for r in run(spark, docs, []).collect())


def test_removal(spark):
    item = " ".join(f"t{i}" for i in range(12))
    docs = [(1, f"Keep THIS, {item}. And this!"), (2, "clean text; stays"), (3, None), (4, item)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    df = table(spark, docs).withColumnRenamed("source", "key").withColumnRenamed("lang", "spans")
    cut = {r["doc_id"]: r["text"] for r in D.remove_spans(spark, df, bench).collect()}
    assert cut == {1: "Keep THIS, And this!", 2: "clean text; stays", 3: None, 4: ""}
    left = D.remove_documents(spark, df, bench)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]


def test_no_python_in_the_plan(spark):
    docs, items = cases()
    plan = run(spark, docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_oracle_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({D.ORACLE_SQL})").fetchall()
    got = [tuple(r) for r in D.op3_decontamination(spark, sf).select(names).collect()]
    assert sorted(got) == sorted(want) and any(r[5] for r in got)
