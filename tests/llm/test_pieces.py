import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import table
from meterbill.llm import pieces as P


@pytest.fixture(scope="module")
def lib():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P.model_path())


@pytest.fixture(scope="module")
def model():
    return P.PieceModel()


def odd_strings(lib, n):
    random.seed(11)
    parts = [" "] * 4 + ["\n", "a", "b", "é", "1", ".", "'s", "　", "▁", "\t", "漢", "日本", "word", "\x1c", "<s>", "<0x41>",
                         "", "\U0001f600", "the", "ing", "th", "==", "--", "****", "\x00", "é"]
    vocabulary = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    return (["", " ", "  ", "a  b", " " * 17 + "x", " " * 40, "x" * 500, "=" * 100, None]
            + ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(n)]
            + ["".join(random.choices(vocabulary, k=random.randint(0, 8))) for _ in range(n)]
            + [" " * random.randint(0, 60) + random.choice(["", "a", "\n", "the "]) + " " * random.randint(0, 40) for _ in range(n // 4)])


def test_equals_the_library(lib, model):
    texts = odd_strings(lib, 2500)
    for a in range(0, len(texts), 200):
        some = texts[a:a + 200]
        ids, counts = model.framed(*model.encode(pa.array(some, pa.string())))
        want = [lib.encode(t or "", add_bos=True, add_eos=True) for t in some]
        assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == want[0]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
        assert [t.decode() for t in model.decode(ids, counts)] == [lib.decode(w) for w in want]


def test_decodes_any_ids(lib, model):
    random.seed(12)
    for _ in range(3000):
        ids = [random.choice([0, 1, 2, random.randrange(3, 259), random.randrange(131, 259), random.randrange(259, 32000), 28705, 259])
               for _ in range(random.randint(0, 9))]
        assert model.decode(np.array(ids, np.int32), np.array([len(ids)]))[0].decode() == lib.decode(ids), ids


def test_dead_ends_are_taken_back(model):
    """Units whose longest first piece is not the merge result."""
    taken_back = 0
    for left in random.Random(5).sample(sorted(t for t in model.id if t.isascii()), 3000):
        text = left + "ing"
        got = [model.text[i] for i in model.encode_unit(text)]
        assert got == model.merged(text)
        taken_back += got[0] != max((text[:n] for n in range(1, len(text) + 1) if text[:n] in model.id), key=len)
    assert taken_back > 100


def test_small_memory_changes_nothing(lib, monkeypatch):
    monkeypatch.setattr(P, "_PAIRS", 3)
    m = P.PieceModel()
    m.entries.most = 5
    texts = [t or "" for t in odd_strings(lib, 100)]
    for t in texts:
        assert m.encode(pa.array([t]))[0].tolist() == lib.encode(t)


def digest(lib, text):
    ids = lib.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())


def test_query_on_odd_texts(spark, folder, odd_texts, lib):
    got = [tuple(r) for r in P.op13_pieces(spark, folder(documents=table(spark, odd_texts).repartition(4))).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(((i, *digest(lib, t)) for i, t in odd_texts), key=key)


def test_query_on_documents(spark, lib):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(map(tuple, P.op13_pieces(spark, sf).collect())) == sorted((r["doc_id"], *digest(lib, r["text"])) for r in rows)


def test_round_trip_keeps_columns(spark, odd_texts):
    docs = table(spark, odd_texts).withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    out = P.decode(P.encode(docs), ids="ids_")
    assert out.columns == [*docs.columns, "ids_", "decoded_"]
    assert all(r["decoded_"] == (r["text"] or "") and r["ids"] == "en" for r in out.collect())
    assert P.decode(P.encode(docs.limit(0)), ids="ids_").count() == 0
    some = spark.createDataFrame([(1, None), (2, [None, 1, 2])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in P.decode(some).collect()} == {1: None, 2: ""}
