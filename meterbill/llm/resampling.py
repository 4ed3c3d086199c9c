"""Importance resampling towards a target: hashed n-gram features, log ratios of
bucket counts as weights, Gumbel noise, and the highest scores drawn.

A feature is a run of 1 to 3 consecutive words, joined by single spaces; its
bucket is the crc32 of its bytes modulo ``BUCKETS``. The crc32s are found for
each distinct feature of a batch at once: features of equal length are the rows
of a two-dimensional uint8 matrix, one column of which updates all their CRCs,
from the first column to the last; the buckets are scattered back to the
feature's places. (Features above ``LONG`` bytes, a handful of endless words,
go to zlib one by one: the matrix would have as many steps as bytes.)

Spark sums the bucket counts (a task sends at most a row for each bucket), the
target's the same way; the gains are one value a bucket and travel to the
scoring tasks. Words and features are found again in the scoring pass: they
take several times the room of the text. Ranks come from range partitions by
(score, doc_id), numbered by the totals of the earlier ones; no task sorts all.

Defined cases: null text and text without words have no features, weight 0, and
are never drawn. The noise of a null ``doc_id`` is that of the text ``42:``.
Rows with equal ``doc_id`` all take part, neighbours in rank; identical rows are
interchangeable. An empty table gives an empty result, an empty target counts
0 in every bucket; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, chunks
from .units import bytes_of, distinct_units, filled

BUCKETS = 10_000
LENGTHS = 3               # words of the longest feature
LEAST_WORDS = 20
PERCENT = 5
LONG = 1024               # bytes of a feature that is left to zlib
_ROWS = 1 << 16           # of one matrix

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_TABLE = _crc_table()


def crc32s(buf: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of each slice ``buf[begin:begin + size]``."""
    out = np.empty(len(begin), np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(order, first[1:])):
        if length > LONG:
            out[rows] = [zlib.crc32(buf[b:b + length]) for b in begin[rows].tolist()]
            continue
        if not length:
            out[rows] = 0
            continue
        windows = np.lib.stride_tricks.sliding_window_view(buf, length)
        for a in range(0, len(rows), _ROWS):
            some = rows[a:a + _ROWS]
            columns = np.ascontiguousarray(windows[begin[some]].T)
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in columns:
                crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ crc >> np.uint32(8)
            out[some] = ~crc
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key's distinct value, and a place of each distinct value."""
    code = pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)
    place = np.empty(int(code.max()) + 1, np.int64)
    place[code] = np.arange(len(code))
    return code, place


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS, lengths: int = LENGTHS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each feature length the texts and buckets of
    all features."""
    buf, ends = bytes_of(filled(texts))
    word = _WORD[buf]
    keep = np.flatnonzero(word)
    if not len(keep):
        return np.zeros(len(texts), np.int64), []
    # a word begins after a byte that is none, and at the start of its text
    before = np.concatenate([[False], word])
    before[ends] = False
    first = np.flatnonzero(word & ~before[:-1])
    counts = np.diff(np.searchsorted(first, ends))
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = np.searchsorted(keep, first)                      # in the bytes of words alone
    size = np.diff(np.append(starts, len(keep)))
    lower = _LOWER[buf[keep]]
    # the words again with one space after each: a feature is one slice of it
    begin = starts + np.arange(len(starts))
    spaced = np.full(len(keep) + len(starts), 32, np.uint8)
    spaced[np.arange(len(keep)) + np.repeat(np.arange(len(starts)), size)] = lower
    number = distinct_units(lower, starts)[0].astype(np.int64)
    found, key = [], number
    for n in range(1, min(lengths, len(number)) + 1):
        if n > 1:                                              # the feature of one word less, and the next word of its text
            key = np.where(owner[:len(key) - 1] == owner[n - 1:], key[:-1] * len(number) + number[n - 1:], -1)
        code, place = _distinct(key)
        at = place[key[place] >= 0]
        last = at + n - 1
        bucket = np.zeros(len(place), np.int64)
        bucket[code[at]] = crc32s(spaced, begin[at], begin[last] + size[last] - begin[at]) % np.uint32(buckets)
        whole = np.flatnonzero(key >= 0)
        found.append((owner[whole], bucket[code[whole]]))
        key = np.where(key >= 0, code, -1)                     # small numbers again
    return counts, found


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, lengths: int = LENGTHS) -> DataFrame:
    """``bucket, n``: features of all texts by bucket (only buckets that have some)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch, most_bytes=2 << 20):
                for _, bucket in feature_buckets(part.column("text"), buckets, lengths)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])
    return docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))).
    Both tables have at most a row for each bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, table in ((s, raw), (t, target)):
        rows = table.toPandas()
        into[rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(doc_id: Column) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))) with h from sha256 of ``42:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit("42:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weights(docs: DataFrame, gain: np.ndarray, lengths: int = LENGTHS) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, most_bytes=2 << 20):
                counts, found = feature_buckets(part.column("text"), len(gain), lengths)
                features, weight = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for owner, bucket in found:
                    features += np.bincount(owner, minlength=part.num_rows)
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                    weight += sums[ends[1:]] - sums[ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(features), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, scratch: Scratch, parts: int, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, score, ...) with ``rank`` of the rows drawn."""
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "row"]
    rows = scored.withColumns({"fit": F.col("n_words") >= least_words, "row": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the upper bits of the position are the range's number, the lower count its rows
    staged = scratch.write(dealt.drop("row").withColumn("position", F.monotonically_increasing_id()), "dealt")
    part, place = F.shiftright("position", 33), F.col("position").bitwiseAND((1 << 33) - 1)
    totals = staged.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count_if("fit").alias("fits"))   # a row for each range
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = F.floor(F.sum("fits").over(Window.partitionBy()) * percent / 100)
    starts = totals.select("part", before.alias("before"), drawn.alias("drawn"))
    rank = place + F.col("before") + 1
    return (staged.join(F.broadcast(starts), part == F.col("part"))
            .withColumn("rank", F.when(rank <= F.col("drawn"), rank)).drop("part", "before", "drawn", "position", "fit"))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, buckets: int = BUCKETS, lengths: int = LENGTHS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of ``docs``."""
    scratch = Scratch(spark, "resample")
    gain = gains(bucket_counts(docs, buckets, lengths), bucket_counts(target, buckets, lengths), buckets)
    scored = scratch.write(weights(docs, gain, lengths).withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "scored")
    return ranked(scored, scratch, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), percent, least_words)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(spark, docs, target).select("doc_id", "n_features", "weight", "score", "rank")


# -- the query in DuckDB SQL ----------------------------------------------------

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
_STEPS = "".join(f", t{i + 1} AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM t{i})"
                 for i in range(8))


def _features(source: str) -> str:
    return f"""SELECT id, w, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM {source}"""


#: crc32 byte by byte through its table of 256 values
ORACLE_SQL = f"""WITH t0 AS (SELECT i, i::BIGINT AS v FROM range(256) r(i)){_STEPS},
table_ AS (SELECT list(v ORDER BY i) AS t FROM t8),
docs AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
bench AS (SELECT row_number() OVER () AS id, {_WORDS} AS w FROM benchmark),
doc_features AS (SELECT id, f, count(*) AS n FROM ({_features('docs')}) GROUP BY ALL),
bench_features AS (SELECT f, count(*) AS n FROM ({_features('bench')}) GROUP BY ALL),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(f)), lambda k:
    ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM doc_features UNION SELECT f FROM bench_features)), table_),
s AS (SELECT bucket, sum(n) AS n FROM doc_features JOIN hashed USING (f) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS n FROM bench_features JOIN hashed USING (f) GROUP BY 1),
gains AS (SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (coalesce((SELECT sum(n) FROM s), 0)::DOUBLE + 10000)
    / ((coalesce(s.n, 0)::DOUBLE + 1) * (coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + 10000)))) AS gain
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weights AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM doc_features JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY id),
scored AS (SELECT id, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (id)),
ranked AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS r, count(*) OVER () AS fit FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * fit // 100 THEN r END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (id)"""
