import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import table
from meterbill.llm import quality as Q
from meterbill.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    s, y = np.asarray(scores)[order], np.asarray(labels)[order]
    ranks = np.searchsorted(s, s, "left") / 2 + np.searchsorted(s, s, "right") / 2 + 0.5
    pos = y.sum()
    return (ranks[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


@pytest.mark.parametrize("query,label,least", [(Q.op5_quality, "quality", 0.97), (T.op1_toxicity, "toxic", 0.92)])
def test_held_out_scores(spark, query, label, least):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc([r["score"] for r in held], [labels[r["doc_id"]] for r in held]) > least


@pytest.mark.parametrize("query", [Q.op5_quality, T.op1_toxicity])
def test_odd_texts(spark, folder, odd_texts, query):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (4, 0, 1), (6, 1, 0), (6, 0, 1), (None, 1, 1), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = query(spark, folder(documents=table(spark, odd_texts), labels=labels)).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in rows)
    scores = {(r["doc_id"]): r["score"] for r in rows}
    assert scores[1] == scores[2] and scores[6] == scores[7]
    none = query(spark, folder(documents=table(spark, odd_texts), labels=labels.limit(0))).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}
    assert query(spark, folder(documents=table(spark, []), labels=labels)).count() == 0


def test_rules_are_columns(spark):
    rule = Q.simplified((("a", True, 3.0), ("b", False, 1.0), ("a", True, 2.0), ("b", False, 0.5)))
    assert rule == (("a", True, 2.0), ("b", False, 1.0))
    df = spark.createDataFrame([(2.0, 1.5), (2.5, 1.5), (2.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(Q.rule_column(rule)).collect()] == [True, False, False]
    got = [r[0] for r in df.select(Q.score_column(([(rule, 2.0)], -1.0))).collect()]
    assert np.allclose(got, [1 / (1 + np.exp(-1)), *[1 / (1 + np.exp(1))] * 2])


def test_learned_rules_separate(spark):
    rng = np.random.default_rng(1)
    rows = [(float(y), *[float(y * 2 + rng.normal() * 0.1) if s == "mark" else float(rng.normal()) for s in Q.STATISTICS])
            for y in (0, 1) for _ in range(150)]
    df = spark.createDataFrame(rows, ["label", *Q.STATISTICS])
    rules, _ = Q.learn(df)
    assert rules and all(any(n == "mark" for n, _, _ in r) for r, w in rules if abs(w) > 1)


def language_model(words):
    n4 = T._gram_counts(__import__("collections").Counter(words)).reshape((27,) * 4)
    p = np.full(27, 1 / 27)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        n = n4.sum(axis=axes)
        p = (n + T._INTERPOLATE * p) / (n.sum(axis=-1, keepdims=True) + T._INTERPOLATE)
    return -np.log(p)


WORDS = ["idiot", "loser", "stupid", "moron", "garden", "letter", "see", "the", "window", "table"] * 30


def test_gram_counts():
    grams = T._gram_counts({"ab": 2, "Éa": 1}).reshape((27,) * 4)
    want = {(0, 0, 0, 1): 2, (0, 0, 1, 2): 2, (0, 1, 2, 0): 2, (0, 0, 0, 5): 1, (0, 0, 5, 1): 1, (0, 5, 1, 0): 1}
    assert {tuple(map(int, i)): int(grams[tuple(i)]) for i in np.argwhere(grams)} == want


def test_viterbi_finds_the_cheapest_path():
    cost = language_model(WORDS)

    def price(letters):
        total, state = 0.0, (0, 0, 0)
        for c in letters + "#":
            k = 0 if c == "#" else ord(c) - 96
            total += cost[(*state, k)]
            state = (0, 0, 0) if k == 0 else (*state[1:], k)
        return total
    for token in ("1d10t", "l00ser", "st.u.p1d", "m 0 r 0 n", "s3e", "l3tt3r!"):
        ways = itertools.product(*T.lattice(token))
        want = min((sum(c for _, c in w) + price("".join(x for x, _ in w)), "".join(x for x, _ in w)) for w in ways)
        assert T.restore(token, cost) == want[1].strip("#")


def test_restoration():
    cost = language_model(WORDS)
    for typed, word in (("1d10t", "idiot"), ("IDIOT!!!", "idiot"), ("l0$er", "loser"), ("stuuuupid", "stupid"), ("m.o.r.o.n", "moron"),
                        ("s-t-u-p-i-d", "stupid"), ("m*ron", "moron"), ("lóser", "loser"), ("letter", "letter"), ("see,", "see")):
        assert T.clean_words(typed, cost) == [word], typed
    assert T.spaced_runs("you i d i o t now a b".split()) == ["i d i o t"]
    assert T.clean_words("i d i o t", cost) == ["idiot"]


def test_obfuscated_words_score_like_plain_ones(spark, folder):
    rng = np.random.default_rng(4)
    vocabulary = ["garden", "letter", "see", "the", "window", "table", "house", "river", "apple", "music"]
    docs, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, 12))
        if i % 4 == 0:
            words.insert(3, "idiot")
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    tricks = ["1d10t", "i d i o t", "idiiiiot", "i.d.i.o.t", "1diot!!", "garden"]
    docs += [(1000 + i, f"the garden see {t} window table") for i, t in enumerate(tricks)]
    out = T.op1_toxicity(spark, folder(documents=table(spark, docs), labels=spark.createDataFrame(labels, "doc_id long, toxic int")))
    got = {r["doc_id"]: r["predicted"] for r in out.collect()}
    assert [got[1000 + i] for i in range(len(tricks))] == [1, 1, 1, 1, 1, 0]


def test_marks_that_hide_letters():
    cost = language_model(WORDS + ["ass", "glass", "viagra", "well", "known", "as", "piss", "at", "a", "grass", "class"] * 30)
    for typed, words in (("id**t", ["idiot"]), ("l**er", ["loser"]), ("i***t", ["idiot"]), ("gla$$", ["glass"]), ("a$$", ["ass"]),
                         ("@$$", ["ass"]), ("4$$", ["ass"]), ("v|@gr@", ["viagra"]), ("i-diot", ["idiot"]), ("st-upid", ["stupid"]),
                         ("pi$$", ["piss"]), ("well-known", ["well", "known"]), ("letter", ["letter"]), ("letter***", ["letter"]),
                         ("letter$$$", ["letter"]), ("$$$", []), ("5.00", []), ("2019", []), ("$20", []), ("1,234", []), ("12:30", []),
                         ("100%", []), ("***", []), ("*******", [])):
        assert T.clean_words(typed, cost) == words, typed


def test_dense_search_equals_the_sparse_one():
    cost = language_model(WORDS)
    for token in ("1d10t", "l00ser", "st.u.p1d", "m 0 r 0 n", "l3tt3r", "i-diot", "m*ron", "gla$$"):
        assert T._restore_dense(token, cost) == T.restore(token, cost)

    def price(letters):
        total, state = 0.0, (0, 0, 0)
        for c in letters + "#":
            k = T._code(c)
            total += cost[(*state, k)]
            state = (0, 0, 0) if k == 0 else (*state[1:], k)
        return total
    for token in ("m**n", "s**", "t**1e"):
        ways = itertools.product(*T.lattice(token))
        want = min((sum(c for _, c in w) + price("".join(x for x, _ in w)), "".join(x for x, _ in w)) for w in ways)
        assert T.restore(token, cost) == want[1].strip("#")


def toxic_corpus():
    rng = np.random.default_rng(4)
    vocabulary = ["garden", "letter", "see", "the", "window", "table", "house", "river", "apple", "music"]
    docs, labels = [], []
    for i in range(400):
        words = list(rng.choice(vocabulary, 12))
        if i % 4 == 0:
            words[3:3] = [["idiot", "moron", "loser"][i % 3], ["stupid", "nasty"][i % 2]]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return docs + [(None, "an idiot"), (7, None), (7, "")], labels


def test_joined_lexicon_gives_the_same_scores(spark):
    docs, labels = toxic_corpus()
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [sorted((str(r["doc_id"]), r["key"], round(r["evidence"], 9), round(r["score"], 9)) for r in
                  T.classify(spark, table(spark, docs), labels, max_lexicon_bytes=most).select("doc_id", F.coalesce("key", F.lit(0)).alias("key"), "evidence", "score").collect())
           for most in (T.MAX_LEXICON_BYTES, 0)]
    assert got[0] == got[1] and len({r[2] for r in got[0]}) > 2


def test_evidence_equals_brute_force(spark):
    """Features counted, weighed and summed row by row in plain Python."""
    docs, labels = toxic_corpus()
    out = {(r["doc_id"], r["key"]): r["evidence"] for r in T.classify(
        spark, table(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in labels}
    learned = [(t, y) for (i, t), (_, y) in zip(docs, labels) if fold[i] not in (0, T.CALIBRATION_FOLD)]
    n = [sum(y == k for _, y in learned) for k in (0, 1)]
    counts = {}
    for t, y in learned:
        for f in {f for w in t.split() for f in T.features_of(w)}:
            counts.setdefault(f, [0, 0])[y] += 1
    weight = {}
    for f, (other, toxic) in counts.items():
        w = np.log((toxic + T.PRIOR) / (n[1] + T.PRIOR)) - np.log((other + T.PRIOR) / (n[0] + T.PRIOR))
        if toxic >= T.MIN_DOCUMENTS and w > max(T.LEAST_WEIGHT, np.sqrt(1 / (toxic + T.PRIOR) + 1 / (other + T.PRIOR))):
            weight[f] = w
    keys = {(r["doc_id"], r["text"]): r["key"] for r in table(spark, docs).select("doc_id", "text", F.xxhash64("text").alias("key")).collect()}
    assert weight
    for i, t in docs:
        best = sorted((max(weight.get(f, 0.0) for f in T.features_of(w)) for w in set((t or "").split())), reverse=True)
        assert abs(out[i, keys[i, t]] - sum(best[:T.TOP])) < 1e-9


def test_predicted_follows_the_threshold(spark):
    for query, least in ((T.op1_toxicity, 0.5), (Q.op5_quality, 0.3)):
        rows = query(spark, "/root/testdata/sf0.01").collect()
        assert all(r["predicted"] == int(r["score"] >= least) for r in rows) and len({r["predicted"] for r in rows}) == 2


def fires(rule, row):
    return all((row[name] <= t) == below for name, below, t in rule)


def test_quality_scores_row_by_row(spark):
    """The compiled columns against rules that plain Python reads."""
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([tuple(float(x) for x in rng.normal(size=len(Q.STATISTICS))) for _ in range(300)], list(Q.STATISTICS))
    rules = [(Q.simplified(tuple((Q.STATISTICS[int(rng.integers(len(Q.STATISTICS)))], bool(rng.integers(2)), float(rng.normal()))
                                 for _ in range(3))), float(rng.normal())) for _ in range(12)]
    got = [r[0] for r in frame.select(Q.score_column((rules, 0.3))).collect()]
    for row, score in zip(frame.collect(), got):
        total = 0.3 + sum(w for rule, w in rules if fires(rule, row))
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_quality_weights_are_optimal(spark):
    """For each rule kept, loss gradient and penalty cancel: moving its weight pays neither way."""
    rng = np.random.default_rng(1)
    rows = [(float(y), *[float(y + rng.normal()) if s in Q.STATISTICS[:3] else float(rng.normal()) for s in Q.STATISTICS])
            for y in (0, 1) for _ in range(300)]
    df = spark.createDataFrame(rows, ["label", *Q.STATISTICS])
    rules, intercept = Q.learn(df)
    data = df.collect()
    fired = np.array([[fires(rule, r) for rule, _ in rules] for r in data], float)
    label = np.array([r["label"] for r in data])
    weight = np.array([w for _, w in rules])
    error = 1 / (1 + np.exp(-(fired @ weight + intercept))) - label
    gradient = fired.T @ error / len(label)
    assert len(rules) > 3 and abs(error.mean()) < 2e-3
    assert np.abs(gradient + Q.PENALTY * np.sign(weight)).max() < 0.2 * Q.PENALTY + 1e-3
