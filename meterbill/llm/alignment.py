"""Alignment of two tokenizers over the same bytes.

Both tokenizers cut a text's bytes (a space, then the text); where tokens of
both end at one byte, a group of A tokens equals a group of B tokens. The two
ascending lists of token ends are merged by merge path: diagonals at equal
distances cross the merge grid, a binary search on each finds how many A and
B ends lie before it, and the pieces between two diagonals have the same
number of steps, whatever the texts. All pieces of a batch advance in step, as
arrays; a piece emits the places where an A end meets a B end (it looks back
over its own border, so ends split by a diagonal still meet), and the groups
that reach over a border are stitched from the pieces' cuts in order.

The last tokens of a group end together: they are linked. How often a pair of
ids is linked corpus-wide is summed in Spark, and joined back to the links.
Documents wait in a written table (ids of pairs, as dictionary-encoded lists).
The pair counts are broadcast only if they have at most ``MAX_BROADCAST_PAIRS``
rows of two longs and a flag; beyond that the same join shuffles, of each
document's distinct pairs.

Defined cases: texts that are null or empty, or that a tokenizer does not give
back byte for byte (U+2581 becomes a space in B), have no tokens: zeros and an
empty string. Rows with equal or null ``doc_id`` are separate rows and all
count. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, chunks, worker_local
from .pieces import PieceModel
from .token_files import Encoder
from .units import bytes_of, filled, gather, space_led

MAX_BROADCAST_PAIRS = 1_000_000
STEPS = 512               # of one merge piece
_B_IDS = 1 << 20          # a pair is a * _B_IDS + b

SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
          "pairs array<long>, times array<int>")


def merge_path(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` lie before each diagonal of the merge of two
    ascending arrays (equal values: ``a`` first); the last diagonal is the end."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        i = (low + high) // 2
        open_ = low < high
        at_a, at_b = np.minimum(i, len(a) - 1), np.clip(diagonal - i - 1, 0, len(b) - 1)
        before = open_ & (a[at_a] <= b[at_b])          # a[i] comes before b[diagonal - i - 1]: take more of a
        low = np.where(before, i + 1, low)
        high = np.where(open_ & ~before, i, high)
    return low, diagonal - low


def common_ends(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` (both strictly ascending) of the values that
    both hold, in order."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at_a, at_b = merge_path(a, b, steps)
    i, j, a_end, b_end = at_a[:-1].copy(), at_b[:-1].copy(), at_a[1:], at_b[1:]
    a_more, b_more = np.append(a, np.iinfo(a.dtype).max), np.append(b, np.iinfo(b.dtype).max)
    a_back = np.concatenate([[-1], a])                 # a_back[i] is the end before a[i]
    met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    piece = np.arange(len(i))
    for _ in range(steps):
        take_a = (i < a_end) & ((j >= b_end) | (a_more[i] <= b_more[j]))
        take_b = ~take_a & (j < b_end)
        hit = np.flatnonzero(take_b & (a_back[i] == b_more[j]))
        if len(hit):
            met.append((piece[hit], i[hit] - 1, j[hit]))
        i += take_a
        j += take_b
    if not met:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of, x, y = (np.concatenate(c) for c in zip(*met))
    order = np.argsort(of, kind="stable")              # pieces in order; each one's cuts are in order
    return x[order], y[order]


class Aligner:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a: str | None = None, b: str | None = None):
        self.a = Encoder(a, None, ordinary=True)
        self.b = PieceModel(b)
        # the byte-level alphabet: printable bytes stand for themselves, the
        # others for the characters from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in printable]
        back = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(others)}
        names = self.a.tok.get_vocab()
        raw: list[bytes] = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            raw[i] = bytes(back[c] for c in name) if all(c in back for c in name) else name.encode()
        self.a_pool, self.a_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
        self.a_start = np.cumsum(self.a_size) - self.a_size
        n = max(len(raw), len(self.b.raw))
        if len(self.b.raw) > _B_IDS:
            raise ValueError(f"the second vocabulary has more than {_B_IDS} ids")
        self.width = len(str(n)) + 1
        digits = [str(i).encode().ljust(self.width) for i in range(n)]
        self.digits = np.frombuffer(b"".join(digits), np.uint8).reshape(n, self.width)
        self.n_digits = np.array([len(str(i)) for i in range(n)])

    def _kept(self, led: pa.Array) -> tuple:
        """Ids of both and their byte ends, without those of texts that do not come back."""
        buf, ends = bytes_of(led)
        a, a_count = self.a.encode_array(led)
        b, b_count = self.b.encode_led(led)
        bad = np.diff(ends) == 0
        for pool, start, size, ids, count in ((self.a_pool, self.a_start, self.a_size, a, a_count),
                                              (self.b.raw_pool, self.b.raw_start, self.b.raw_size, b, b_count)):
            total = np.concatenate([[0], np.cumsum(size[ids])])
            at = np.cumsum(count)
            bytes_each = total[at] - total[at - count]
            bad |= bytes_each != np.diff(ends)
            good_ids = ids[np.repeat(~bad, count)]
            back = gather(pool, start[good_ids], size[good_ids])
            want = buf[np.repeat(~bad, np.diff(ends))]
            differs = np.flatnonzero(back != want)
            if len(differs):
                good_ends = np.cumsum(np.diff(ends)[~bad])
                bad[np.flatnonzero(~bad)[np.unique(np.searchsorted(good_ends, differs, side="right"))]] = True
        a, b = a[np.repeat(~bad, a_count)], b[np.repeat(~bad, b_count)]
        return a, np.where(bad, 0, a_count), b, np.where(bad, 0, b_count)

    def align(self, texts: pa.Array) -> tuple:
        """Of each text: A tokens, B tokens, groups, the groups as bytes, and its
        distinct linked pairs (text, pair, how many times)."""
        a, a_count, b, b_count = self._kept(space_led(filled(texts)))
        cut_a, cut_b = common_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b.raw_size[b]))
        a_ends = np.cumsum(a_count)
        text_of = np.searchsorted(a_ends, cut_a, side="right")
        n_groups = np.bincount(text_of, minlength=len(texts))
        # where each token comes in "a,a|b;a|b,b": the tokens of earlier groups, its own group's A before its B
        group_a = np.concatenate([[0], np.diff(cut_a, prepend=-1).cumsum()])
        group_b = np.concatenate([[0], np.diff(cut_b, prepend=-1).cumsum()])
        sizes_a, sizes_b = np.diff(group_a), np.diff(group_b)
        out = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(group_b[:-1], sizes_a)
        place_b = np.arange(len(b)) + np.repeat(group_a[1:], sizes_b)
        out[place_a], out[place_b] = a, b
        mark = np.full(len(out), ord(","), np.uint8)
        mark[place_a[cut_a]], mark[place_b[cut_b]] = ord("|"), ord(";")
        length = self.n_digits[out]
        rows = self.digits[out]
        rows[np.arange(len(out)), length] = mark
        written = rows[np.arange(self.width) <= length[:, None]].tobytes()
        total = np.concatenate([[0], np.cumsum(length + 1)])
        ends = np.cumsum(a_count + b_count)
        groups = [written[x:y - 1] if y > x else b"" for x, y in
                  zip(total[ends - a_count - b_count].tolist(), total[ends].tolist())]
        pair = a[cut_a].astype(np.int64) * _B_IDS + b[cut_b]
        order = np.lexsort((pair, text_of))
        pair, of = pair[order], text_of[order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])])[:len(pair)])
        return a_count, b_count, n_groups, groups, of[new], pair[new], np.diff(np.append(new, len(pair)))


def _align_batches(a: str | None, b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_local(f"aligner {a} {b}", lambda: Aligner(a, b))
        for batch in batches:
            for part in chunks(batch, most_bytes=2 << 20):
                n_a, n_b, n_groups, groups, of, pair, times = aligner.align(part.column("text"))
                offsets = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                     pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(pair)),
                     pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])
    return run


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) aligned: its token and group counts, and
    its distinct linked id pairs (``a * 2**20 + b``) with how often each occurs."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(_align_batches(a, b), SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, linked, best``: links of each pair in all documents, and whether no
    other A id is linked more often with its B id."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("linked"))
    b = F.col("pair") % _B_IDS
    most = counts.groupBy(b.alias("b")).agg(F.max("linked").alias("most"))
    return counts.join(F.broadcast(most), b == F.col("b")).select(         # at most a row for each id of B
        "pair", "linked", (F.col("linked") == F.col("most")).alias("best"))


def link_sums(spark: SparkSession, docs: DataFrame, a: str | None = None, b: str | None = None,
              max_broadcast: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    scratch = Scratch(spark, "align")
    aligned = scratch.write(align(docs, a, b), "aligned")
    counts = scratch.write(pair_counts(aligned), "pairs")
    small = counts.count() <= max_broadcast
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    sums = (links.join(F.broadcast(counts) if small else counts, "pair").groupBy("row")
            .agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("linked")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (aligned.drop("pairs", "times").join(sums, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
                    "groups_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_sums(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
