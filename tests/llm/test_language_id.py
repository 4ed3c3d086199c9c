import itertools
import zlib

import numpy as np

from conftest import table
from meterbill.llm import language_id as L


def segmentations(word, pieces):
    """All ways to cut ``word``; a character without a piece is one unknown."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield (pieces.index(word[:n]), *rest)
    if word and word[0] not in pieces:
        for rest in segmentations(word[1:], pieces):
            yield (len(pieces), *rest)


PIECES = ["a", "b", "ab", "▁", "▁a", "ba", "é", "漢"]
WORDS = ["▁" + "".join(w) for n in range(1, 6) for w in itertools.product("abxé漢", repeat=n)][::7]


def test_forward_sums_all_segmentations():
    lattice = L.Lattice(PIECES)
    prob = np.random.default_rng(1).random((len(PIECES) + 1, 3))
    got = np.exp(lattice.log_probability(WORDS, lattice.scaled(prob)))
    want = np.array([sum(np.prod(prob[list(s)], axis=0) for s in segmentations(w, PIECES)) for w in WORDS])
    assert np.allclose(got, want)


def test_long_words_of_rare_characters_keep_finite_logs():
    """Pieces of a language learned from 1e9 pieces; no cut has a large probability."""
    lattice = L.Lattice(PIECES)
    prob = np.full((len(PIECES) + 1, 2), [[0.5e-9, 1e-10]])
    words = ["x" * 64, "é" * 60, "x" * 3]
    logs = lattice.log_probability(words, lattice.scaled(prob))
    assert np.isfinite(logs).all()
    assert np.allclose(logs, np.array([[64], [60], [3]]) * np.log([[0.5e-9, 1e-10]]))


def test_expected_counts_weight_all_segmentations():
    lattice, counts = L.Lattice(PIECES), np.arange(len(WORDS) * 2, dtype=float).reshape(-1, 2)
    n = len(PIECES) + 1
    want = np.zeros((n, 2))
    for w, c in zip(WORDS, counts):
        ways = list(segmentations(w, PIECES))
        weight = np.array([n ** -float(len(s)) for s in ways])
        for s, x in zip(ways, weight / weight.sum()):
            for piece in s:
                want[piece] += x * c
    assert np.allclose(lattice.expected_counts(WORDS, counts), want)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in L.op4_language_id(spark, sf).collect()]
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98


def test_odd_texts(spark, folder, odd_texts):
    train = [(100 + i, t, lang) for i in range(20) for t, lang in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
    docs = table(spark, odd_texts + train + [(900, "the dog", None), (901, None, "fr"), (902, "!", "fr")])
    got = L.op4_language_id(spark, folder(documents=docs)).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 5, 901, 902))
    assert by_id[900]["lang_pred"] == "en" and by_id[6]["lang_pred"] in ("en", "de", "fr")


def test_nothing_to_learn(spark, folder):
    rows = L.op4_language_id(spark, folder(documents=table(spark, [(1, "text", None)]))).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    assert L.op4_language_id(spark, folder(documents=table(spark, []))).count() == 0


def test_accept_keeps_columns_and_clean_rows(spark):
    train = [(i, t, lang) for i in range(30) for t, lang in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
    docs = table(spark, train + [(99, "12345"), (98, None)]).withColumnRenamed("source", "score").withColumnRenamed("n_chars", "key")
    out = L.accept(spark, docs)
    assert out.columns == docs.columns and out.count() == len(train)
