import os

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture()
def folder(spark, tmp_path):
    """Writes tables as a driver folder and returns its path."""
    def write(**tables):
        path = f"{tmp_path}/sf{len(os.listdir(tmp_path))}"
        for name, df in tables.items():
            df.write.parquet(f"file://{path}/{name}.parquet")
        return f"file://{path}"
    return write


@pytest.fixture()
def odd_texts():
    """Null, empty, blank, one word, no letters, repeated rows, very long."""
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, "123 456 !!"), (6, "same text here now"),
            (6, "same text here now"), (7, "same text here now"), (None, "no id for this text"),
            (8, "long words " * 20_000), (9, "x" * 100_000), (10, "é ñ ß 漢字 \U0001f600 end")]
