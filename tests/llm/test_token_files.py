import glob
import random
import zlib

import numpy as np
import pyarrow.parquet as pq

from conftest import table  # noqa: F401  (tests/llm/conftest.py)
from meterbill.llm import token_files as T


def whole(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [T.END_ID]


def test_encoder_equals_the_library():
    tok, enc = T.load_tokenizer(), T.Encoder(None, T.END_ID)
    random.seed(3)
    parts = [" ", " ", "\n", "a", "B", "é", "1", ".", "'s", "　", "Ġ", "\t", "漢", "word", "\x1c", "<|endoftext|>"]
    texts = ["", " ", "  ", "a  b", "it's\n\n ok", "x" * 500] + [
        "".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(1500)]
    for a in range(0, len(texts), 50):
        some = texts[a:a + 50]
        ids, sizes = enc.encode(some)
        ends = np.cumsum(sizes)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == [whole(tok, t) for t in some]


def brute(rows):
    tok, out, start = T.load_tokenizer(), [], 0
    for doc_id, text in rows:
        ids = whole(tok, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_odd_texts(spark, folder, odd_texts):
    path = folder(documents=table(spark, odd_texts).repartition(4))
    got = [tuple(r) for r in T.op2_token_files(spark, path).collect()]
    order = sorted(odd_texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(got, key=lambda r: r[1]) == brute(order)


def test_query_on_documents(spark):
    docs = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{docs}/documents.parquet").collect())
    assert sorted(map(tuple, T.op2_token_files(spark, docs).collect())) == brute(rows)


def test_empty_table(spark, folder):
    assert T.op2_token_files(spark, folder(documents=table(spark, []))).count() == 0


def test_file_layout_and_selective_reads(spark, tmp_path):
    docs = table(spark, [(i, f"text number {i} " * 50) for i in range(300)])
    path = f"{tmp_path}/tokens"
    T.write_tokens(spark, docs, path, files=2)
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
                   for i in range(meta.num_columns)}
        ids = next(c for n, c in columns.items() if n.startswith("ids"))
        assert "RLE_DICTIONARY" in ids.encodings and ids.has_offset_index and ids.has_column_index
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].statistics.has_min_max
    some = T.read_tokens(spark, path).where("doc_id BETWEEN 10 AND 12")
    plan = some.select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0] and some.count() == 3
