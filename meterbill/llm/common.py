"""Helpers shared by the operators of this package.

Row identity: operators that come back to a document in a second pass key it
by ``(doc_id, xxhash64(text))``, never by a position in a scan, because the
split of a scan into tasks may differ between two jobs when executors come
and go. Rows equal in both are one document and share its fate.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.session import scratch_path


class Scratch:
    """Tables written below the folder that driver and executors share
    (``spark.checkpoint.dir``); ``drop`` removes those that no later step
    reads. The tables behind a returned DataFrame stay until the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, f"llm-{name}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write ``df`` and read it back: cuts the lineage, survives the loss
        of executors."""
        path = self.path(name)
        df.write.mode("overwrite").options(**options).parquet(path)
        # what led here is not needed again: let the cleaner find its shuffle files,
        # which the first collection only unlinks from the query that wrote them
        self.spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def broadcast_if_small(df: DataFrame, row_bytes: Column, most: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows, of ``row_bytes`` each, take at most
    ``most`` bytes together; else as it is, for a join by shuffle."""
    total = df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df


def worker_local(key: str, make):
    """One object for all tasks that a Python worker process runs in turn."""
    import sys
    from types import ModuleType

    held = sys.modules.setdefault("meterbill_worker_local", ModuleType("meterbill_worker_local")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def giving_back(run):
    """``run`` of a task; at its end the memory that is free but kept by the allocators
    goes back to the system: the worker process lives on beside the executor's JVM."""
    def wrapped(batches):
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # glibc only
        if trim:
            trim(0)
    return wrapped


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32(doc_id as text) mod 5 = 0.
    A null id counts as the empty text, whose crc32 is 0: held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def text_key(text: Column) -> Column:
    """Content part of a document's identity."""
    return F.xxhash64(text)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


# -- hashing of words and shingles, vectorised over the bytes of a batch -----

_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n of the base and of its inverse (kept for the next call)."""
    if not _POWERS or len(_POWERS[0]) <= n:
        made = []
        for base in (_BASE, np.uint64(_inverse(int(_BASE)))):
            power = np.full(n + n // 4 + 1, base, np.uint64)
            power[0] = 1
            made.append(np.multiply.accumulate(power))
        _POWERS[:] = made
    return _POWERS


def segment_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range ``buf[start:end]`` (polynomial over a
    random byte table, all ranges from one prefix sum)."""
    n = len(buf)
    if not len(start):
        return np.zeros(0, np.uint64)
    power, back = _powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[:n], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * back[start]
    return mix64(h + (end - start).astype(np.uint64) * _ODD[0])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of all
    texts in order, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raw])
    space = _SPACE[buf]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    hashes = segment_hashes(buf, first, last)
    counts = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))
    return hashes, counts


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text, one
    after another, and the size of each set. Fewer than ``k`` words make one
    shingle of all of them; no word makes the empty set."""
    words, counts = words_of(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    begin = np.cumsum(counts) - counts
    place = np.arange(len(words)) - begin[doc]
    full = place + k <= counts[doc]
    at = np.flatnonzero(full)
    h = np.full(len(at), np.uint64(k), np.uint64)
    for j in range(k):
        h = mix64(h * _ODD[1] + words[at + j])
    owner = doc[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = []
        for i in short:
            x = np.full(1, np.uint64(counts[i]), np.uint64)
            for w in words[begin[i]:begin[i] + counts[i]]:
                x = mix64(x * _ODD[1] + w)
            extra.append(x[0])
        h = np.concatenate([h, np.array(extra, np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        h, owner = h[keep], owner[keep]
    return h, np.bincount(owner, minlength=len(texts))


def chunks(batch: pa.RecordBatch, text: str = "text", most_bytes: int = 8 << 20):
    """Slices of a batch whose texts take about ``most_bytes`` together (one
    longer text makes a slice of its own): bounds the memory of the
    vectorised steps."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, s in enumerate(sizes):
        if i > at and total + s > most_bytes:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(s)
    if at < len(sizes):
        yield batch.slice(at)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores if the caller's table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
