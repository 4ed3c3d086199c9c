"""Benchmark decontamination with DataFrame functions only.

Benchmark texts give windows of ``n`` consecutive normalised words (an item
of fewer words is one window). Their 64-bit hashes are the broadcast set;
every document's windows are hashed (by doubling: windows of 2, 4, 8 words
are combined, not re-read), looked up, and each hit is verified word by word.
Hits are then spans of words to cut, or documents to drop.

A set of more than ``MAX_BROADCAST_WINDOWS`` windows (they are counted) is cut
by hash into blocks of about that size; each block is broadcast in a scan of
its own and the hits are put together, with the same result.

Defined cases: null and empty texts have no words and are clean; items
without words are skipped; a null item id counts as the id ''. Repeated items
count once. Rows of ``documents`` that are equal in ``doc_id`` and text share
their verdict. Empty tables give empty results (an empty benchmark: nothing
is contaminated). Columns of the caller keep their names and values, whatever
they are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, text_key

WINDOW = 10
MAX_BROADCAST_WINDOWS = 2_000_000
_MARKERS = 1024          # salts of the row that every document sends along
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_AND_REST = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words(text: Column) -> Column:
    """Normalised words: A-Z lower-cased, runs of 0-9, a-z and non-ASCII."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered, _BREAKS), "")


def _joined(a: Column, b: Column, gap: int) -> Column:
    """Hashes of the windows ``a[i] + b[i + gap]``."""
    n = F.greatest(F.lit(0), F.least(F.size(a), F.size(b) - gap))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(gap + 1), n), lambda x, y: F.xxhash64(x, y))


def with_window_hashes(df: DataFrame, length: int, word_hashes: str, out: str) -> DataFrame:
    """Add ``out``: the hash of each window of ``length`` words."""
    power, at = {1: word_hashes}, 1
    while at * 2 <= length:
        name = fresh(df, f"h{at * 2}")
        df = df.withColumn(name, _joined(F.col(power[at]), F.col(power[at]), at))
        at *= 2
        power[at] = name
    have, name = at, power[at]
    for p in sorted(power, reverse=True)[1:]:
        if have + p <= length:
            made = fresh(df, f"w{have + p}")
            df = df.withColumn(made, _joined(F.col(name), F.col(power[p]), have))
            have, name = have + p, made
    return df.withColumn(out, F.col(name)).drop(*[c for c in set(power.values()) | {name} if c != word_hashes])


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``h, length, gram, items``: one row for each distinct window."""
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
             .where(F.size("w") > 0).withColumn("length", F.least(F.lit(n), F.size("w"))))
    grams = items.select("item", "length", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.slice("w", i, F.col("length")))).alias("gram"))
    return grams.groupBy("length", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _with_hash(grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The same hash as a document's window of these words gets."""
    out = None
    for n in lengths:
        part = grams.where(F.col("length") == n).withColumn("g1", F.transform("gram", lambda w: F.xxhash64(w)))
        part = with_window_hashes(part, n, "g1", "hs").select(F.element_at("hs", 1).alias("h"), "length", "gram", "items")
        out = part if out is None else out.unionByName(part)
    return out


def scan(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, key, n_words, spans`` (array
    of [begin, end) word positions, merged) and ``items`` (sorted ids)."""
    grams = benchmark_windows(benchmark, n)
    sizes = {r["length"]: r["count"] for r in grams.groupBy("length").count().collect()}   # at most n rows
    lengths = sorted(sizes, reverse=True)
    blocks = max(1, -(-sum(sizes.values()) // MAX_BROADCAST_WINDOWS))
    if blocks == 1:
        return _scan_block(spark, docs, _with_hash(grams, lengths) if lengths else None, lengths)
    hits = None
    for b in range(blocks):
        block = _with_hash(grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b), lengths)
        part = _scan_block(spark, docs, block, lengths).where(F.size("spans") > 0)
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")).agg(
        merged(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (rows.join(hits, rows["doc_id"].eqNullSafe(hits["hit_id"]) & (rows["key"] == hits["hit_key"]), "left")
            .select("doc_id", "key", "n_words", F.coalesce("spans", F.array().cast("array<struct<begin:int,end:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _scan_block(spark: SparkSession, docs: DataFrame, grams: DataFrame | None, lengths: list[int]) -> DataFrame:
    """``scan`` against windows that fit a broadcast."""
    marker = spark.range(_MARKERS).select(
        F.col("id").alias("h"), F.lit(0).alias("length"), F.array().cast("array<string>").alias("gram"),
        F.array().cast("array<string>").alias("items"))
    table = F.broadcast(marker if grams is None else marker.unionByName(grams))
    d = docs.select("doc_id", text_key(F.col("text")).alias("key"), words(F.col("text")).alias("w"))
    d = (d.withColumn("row", F.monotonically_increasing_id()).withColumn("n_words", F.size("w"))
          .withColumn("h1", F.transform("w", lambda x: F.xxhash64(x))))
    for n_words in lengths:
        d = with_window_hashes(d, n_words, "h1", f"win{n_words}")
    hashes = F.concat(F.array(F.col("row") % _MARKERS), *[F.col(f"win{x}") for x in lengths])
    d = d.select("doc_id", "key", "row", "n_words", "w", F.posexplode(hashes).alias("at", "h"))
    # the place in the joined array tells window length and position (1-based); 0 is the marker
    length, begin, past = F.lit(0), F.lit(0), F.lit(0)
    for x in reversed(lengths):
        before = F.lit(0)
        for y in lengths[:lengths.index(x)]:
            before = before + F.greatest(F.lit(0), F.col("n_words") - (y - 1))
        count = F.greatest(F.lit(0), F.col("n_words") - (x - 1))
        inside = (F.col("at") > before) & (F.col("at") <= before + count)
        length, begin = F.when(inside, x).otherwise(length), F.when(inside, F.col("at") - before).otherwise(begin)
    # one row for each hit, and one marker row for each document
    verified = ((F.col("d.h") == F.col("t.h")) & (F.col("t.length") - length == 0)   # not a key: one long is looked up
                & (F.slice(F.col("w"), F.greatest(F.lit(1), begin), F.col("t.length")) == F.col("t.gram")))
    hits = (d.alias("d").join(table.alias("t"), verified)
            .select("d.doc_id", "d.key", "d.row", "d.n_words", "t.length", "t.items", (begin - 1).alias("begin")))
    found = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("key").alias("key"), F.first("n_words").cast("long").alias("n_words"),
        F.collect_list(F.when(F.col("length") > 0, F.struct("begin", (F.col("begin") + F.col("length")).alias("end")))).alias("spans"),
        F.collect_set("items").alias("items"))
    return found.select("doc_id", "key", "n_words", merged(F.col("spans")).alias("spans"),
                        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def merged(spans: Column) -> Column:
    """Union of [begin, end) spans as ascending disjoint spans."""
    none = F.array().cast("array<struct<begin:int,end:int>>")

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                         F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (s["begin"] <= F.try_element_at(acc, F.lit(-1))["end"]), grown).otherwise(
            F.concat(acc, F.array(s)))

    # only where a span begins past all earlier ones does the list grow
    return F.aggregate(F.array_sort(spans), none, add)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The report: counts and the digest of the items found in each document."""
    found = scan(spark, docs, benchmark, n)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def remove_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = scan(spark, docs, benchmark, n).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("bad_id")) & (text_key(docs["text"]) == F.col("bad_key")), "left_anti")


def remove_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` with the words of every hit (and what follows each of them up
    to the next word) cut from ``text``; other texts stay byte for byte."""
    names = docs.columns
    i, k, s = fresh(docs, "bad_id"), fresh(docs, "bad_key"), fresh(docs, "spans")
    bad = (scan(spark, docs, benchmark, n).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias(i), F.col("key").alias(k), F.col("spans").alias(s)).dropDuplicates([i, k]))
    joined = docs.join(bad, docs["doc_id"].eqNullSafe(F.col(i)) & (text_key(docs["text"]) == F.col(k)), "left")
    pieces = F.regexp_extract_all("text", F.lit(_WORD_AND_REST), F.lit(0))
    kept = F.filter(pieces, lambda p, at: ~F.exists(F.col(s), lambda x: (at >= x["begin"]) & (at < x["end"])))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    cut = F.concat(lead, F.array_join(kept, ""))
    return joined.withColumn("text", F.when(F.col(s).isNull(), F.col("text")).otherwise(cut)).select(*names)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM g),
spots AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths)
), h AS (SELECT rid, i, n, item FROM spots JOIN g USING (n, gram)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
