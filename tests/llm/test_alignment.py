import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import table
from meterbill.llm import alignment as A
from meterbill.llm.pieces import model_path
from meterbill.llm.token_files import load_tokenizer


def test_merge_path_deals_equal_work():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.flatnonzero(rng.random(int(rng.integers(0, 300))) < 0.4) for _ in range(2))
        steps = int(rng.integers(1, 50))
        i, j = A.merge_path(a, b, steps)
        assert i[-1] == len(a) and j[-1] == len(b) and (np.diff(i + j)[:-1] == steps).all()
        order = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        for x, y in zip(i.tolist(), j.tolist()):
            assert sum(s == 0 for _, s in order[:x + y]) == x
        got_a, got_b = A.common_ends(a, b, steps)
        _, want_a, want_b = np.intersect1d(a, b, return_indices=True)
        assert np.array_equal(got_a, want_a) and np.array_equal(got_b, want_b)


@pytest.fixture(scope="module")
def libs():
    import sentencepiece
    tok = load_tokenizer()
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=model_path())


def byte_alphabet():
    """Character of the byte-level alphabet -> byte."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}


def brute(libs, texts):
    """Rows without doc_id, by comparing all ends of A and B of each text."""
    tok, lib = libs
    back = byte_alphabet()
    bytes_a = [b""] * tok.get_vocab_size()
    for name, i in tok.get_vocab().items():
        bytes_a[i] = bytes(back[c] for c in name) if all(c in back for c in name) else name.encode()
    bytes_b = [bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, lib.id_to_piece(i)) for i in range(lib.get_piece_size()))]
    found, counts = [], Counter()
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = lib.encode(t) if t else []
        if any(b"".join(raw[i] for i in ids) != (" " + t).encode() for raw, ids in ((bytes_a, a), (bytes_b, b)) if t):
            a, b = [], []
        ends_a, ends_b = (np.cumsum([len(raw[i]) for i in ids]).tolist() for raw, ids in ((bytes_a, a), (bytes_b, b)))
        links = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            n, m = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:n])) + "|" + ",".join(map(str, b[j:m])))
            i, j = n, m
        counts.update(links)
        found.append((a, b, groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for a, b, groups, links in found]


def odd(n):
    random.seed(2)
    parts = [" ", " ", "\n", "a", "é", "1", ".", "'s", "　", "▁", "\t", "漢", "word", "the", "<|endoftext|>", "<s>", "<0x41>", "", "\U0001f600"]
    return ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def want(libs, rows):
    return sorted(((i, *w) for (i, _), w in zip(rows, brute(libs, [t for _, t in rows]))), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("limit", [A.MAX_BROADCAST_PAIRS, 0])
def test_equals_brute_force(spark, odd_texts, libs, limit):
    short = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in odd_texts]
    rows = short + [(100 + i, t) for i, t in enumerate(odd(300))]
    assert rows_of(A.link_sums(spark, table(spark, rows).repartition(5), max_broadcast=limit)) == want(libs, rows)


def test_query_on_documents(spark, libs):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    some = [r for r in rows if len(r[1]) < 2000]
    got = {r[0]: r for r in rows_of(A.op12_alignment(spark, sf))}
    assert len(got) == len(rows)
    # lengths, groups and their digest do not depend on the other documents
    for r in want(libs, some):
        assert got[r[0]][1:5] == r[1:5] and got[r[0]][7] == r[7]
    assert rows_of(A.link_sums(spark, table(spark, some))) == want(libs, some)


def test_small_pieces_give_the_same_groups(monkeypatch):
    aligner = A.Aligner()
    texts = pa.array([*odd(50), None, "long words " * 3000])
    whole = aligner.align(texts)
    plain = A.common_ends
    monkeypatch.setattr(A, "common_ends", lambda a, b: plain(a, b, 3))
    again = aligner.align(texts)
    assert all(np.array_equal(x, y) for x, y in zip(whole, again))


def test_empty_table(spark, folder):
    assert A.op12_alignment(spark, folder(documents=table(spark, []))).count() == 0
