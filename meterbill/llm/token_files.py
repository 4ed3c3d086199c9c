"""Token ids as Parquet list columns.

A table of token shards: ``doc_id``, ``start`` (ids before this document),
``n_tokens`` and ``ids`` (list of int). Ids are dictionary encoded (a
vocabulary fits one dictionary page); ``doc_id``, ``start`` and ``n_tokens``
are ascending or small and are delta encoded. Row groups and pages have set
sizes and carry min/max indexes, so a filter on ``doc_id`` or ``start`` reads
a few pages, and a read of the metadata columns never touches the ids.

Documents are dealt by ranges of ``doc_id``: file order is id order. ``start``
is the sum of earlier files (one row a file) plus the sum within the file.

Defined cases: null text is the empty text and gets the end id alone. A null
``doc_id`` comes first. Rows with equal ``doc_id`` are neighbours, ordered by
text hash; identical rows are interchangeable and are spread over files when
they are many. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _SPACE, Scratch, chunks, worker_local
from .units import Entries, Learned, bytes_of, cut, filled, flat, per_text

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 4096
WRITE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",            # delta encodings where a dictionary is off
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.dictionary.page.size": str(4 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start": "false",
    "parquet.enable.dictionary#place": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}
_TOGETHER = 2_000        # new units that the library gets in one text
_MARKS = ".,!?;:"        # that often end a word


def load_tokenizer(path: str | None = None):
    """The byte-level BPE tokenizer at ``path`` (default: the public 50k one
    installed on every machine)."""
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return Tokenizer.from_file(path)


#: Unicode white space outside ASCII, as UTF-8 (fixed values)
_WHITE_2 = ("\u0085", "\u00a0")
_WHITE_3 = ("\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.isin(np.arange(256), [ord(c) for c in _MARKS])


def _code(c: str) -> int:
    return int.from_bytes(c.encode(), "big")


def white(buf: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    out = _SPACE[buf]
    for chars, lead in ((_WHITE_2, (0xC2, 0xC2)), (_WHITE_3, (0xE1, 0xE3))):
        n = len(chars[0].encode())
        at = np.flatnonzero((buf >= lead[0]) & (buf <= lead[1]))
        at = at[at + n <= len(buf)]
        if len(at):
            code = np.zeros(len(at), np.int64)
            for k in range(n):
                code = code << 8 | buf[at + k]
            hit = at[np.isin(code, [_code(c) for c in chars])]
            for k in range(n):
                out[hit + k] = True
    return out


class Encoder:
    """Ids of whole texts, equal to the library's.

    Byte-level pre-tokenization never lets a token span the place before a
    single space, or around a single newline, that has no white space beside
    it, nor that between an ASCII letter and a mark: texts are cut there into
XX that hold an added token's
    string are not cut, unless such strings are ``ordinary`` text.
    """

    def __init__(self, path: str | None, end_id: int | None, ordinary: bool = False):
        self.tok = load_tokenizer(path)
        self.tok.encode_special_tokens = ordinary
        self.special = [] if ordinary else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.end_id = end_id
        vocabulary = self.tok.get_vocab()
        added = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, i in vocabulary.items():     # a character of the byte-level alphabet is a byte
            self.id_bytes[i] = len(name.encode()) if name in added else len(name)
        self.entries = Entries(self._learn)

    def _learn(self, units: list[bytes]) -> Learned:
        blob = np.frombuffer(b"".join(units), np.uint8)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes)
        begin, blank = ends - sizes, white(blob)
        second = np.minimum(begin + 1, len(blob) - 1)
        led = (sizes > 1) & (blob[begin] == 32) & ~blank[second] & ~blank[ends - 1]
        # units led by their space stay apart when they are put in a row
        row, rest = [units[n] for n in np.flatnonzero(led)], [units[n] for n in np.flatnonzero(~led)]
        texts = [b"".join(row[n:n + _TOGETHER]).decode("utf-8", "surrogatepass") for n in range(0, len(row), _TOGETHER)]
        together = [np.array(e.ids, np.int32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int32), *together])
        to = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(sizes[led]))
        alone = self.tok.encode_batch_fast([u.decode("utf-8", "surrogatepass") for u in rest], add_special_tokens=False)
        _, more, counts = flat(rest, [e.ids for e in alone])
        return row + rest, np.concatenate([ids, more]), np.concatenate([np.diff(to + 1, prepend=0), counts])

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (no end ids), and the number of ids of each text (no nulls)."""
        buf, ends = bytes_of(texts)
        blank = white(buf)
        lone = np.flatnonzero((buf == 32) | (buf == 10))
        lone = lone[(lone > 0) & (lone + 1 < len(buf))]
        lone = lone[~(blank[lone - 1] | blank[lone + 1])]
        marks = np.flatnonzero(_MARK[buf[1:]] & _LETTER[buf[:-1]]) + 1
        cuts = np.sort(np.concatenate([lone, lone[buf[lone] == 10] + 1, marks]))
        for s in self.special:
            for t in np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False)):
                cuts = cuts[(cuts <= ends[t]) | (cuts >= ends[t + 1])]
        begin, units = cut(buf, ends, cuts)
        ids, size = self.entries.ids(buf, begin)
        return ids, per_text(size, units)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text (end id included)."""
        ids, counts = self.encode_array(filled(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())))
        ends = np.cumsum(counts + 1)
        out = np.empty(len(ids) + len(counts), np.int32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner], out[ends - 1] = ids, self.end_id
        return out, counts + 1


def _encode_batches(path: str | None, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_local(f"encoder {path} {end_id}", lambda: Encoder(path, end_id))
        place = 0                                       # ids of this file so far
        for batch in batches:
            for part in chunks(batch, most_bytes=4 << 20):
                ids, lengths = encoder.encode(part.column("text"))
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("part"), pa.array(place + offsets[:-1]), pa.array(lengths),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                    ["doc_id", "part", "place", "n_tokens", "ids"])
                place += int(offsets[-1])
    return run


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str | None = None,
                 end_id: int = END_ID, files: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the token table at ``path``."""
    files = files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = (rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "tie", "row")
                 .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "row")
                 .select("doc_id", F.spark_partition_id().alias("part"), "text"))
    encoded = dealt.mapInArrow(_encode_batches(tokenizer, end_id),
                               "doc_id long, part int, place long, n_tokens long, ids array<int>")
    encoded.write.mode("overwrite").options(**WRITE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a token table. The sums by file read
    two small columns; they are one row a file."""
    table = spark.read.parquet(path)
    sums = table.groupBy("part").agg(F.sum("n_tokens").alias("in_file"))
    before = F.coalesce(F.sum("in_file").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("part", before.alias("before"))
    return (table.join(F.broadcast(starts), "part")      # a row for each file
                 .select("doc_id", (F.col("place") + F.col("before")).alias("start"), "n_tokens", "ids"))


def _crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "op2").path("tokens")
    write_tokens(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path).mapInArrow(
        _crc_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
