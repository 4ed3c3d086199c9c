"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its distinct ``k``-word shingles. Two documents link
when their sets' Jaccard similarity reaches ``num / den``; linked documents
form components.

1. Equal sets are one class; classes are searched, copies follow them.
2. Shingles that many documents hold are counted over all documents, so that
   every set can be ordered from rare to frequent. With ``T = ceil(t * size)``
   the least overlap, two linked sets share ``l`` of their ``size - T + l``
   rarest shingles: only these are put in inverted lists.
3. Short lists (at most ``_SHORT`` sets) are merged: each pair's common lists are
   counted. A pair stays if these, and the long lists that both could still
   share, reach ``l``; sets with ``l`` long lists also meet in those. What meets
   forms groups.
4. In a group, inverted
   lists are built and each set asks for those that occur in at least T of its
   lists: the short lists are merged by a heap, survivors of ``T - L`` are
   probed by binary search in the ``L`` long lists, and the exact overlap decides.

The order of shingles only steers the work: any order common to all documents
finds every link. That is why the table of counted shingles may be held to a
fixed size (the most frequent ones).

Defined cases: null and empty texts (and texts without words) have the empty
set, link with nothing and are their own component. Fewer than ``k`` words are
one shingle. A component is named by its smallest ``doc_id``; a null id counts
only if there is no other. Repeated rows are copies of each other. An empty
table gives an empty result; columns of the caller are kept whatever their names.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusters import Forest, components, deal, spanning_links
from .common import Scratch, broadcast_if_small, chunks, fresh, giving_back, mix64, shingle_sets, text_key, texts_of

MAX_COUNTED = 1_000_000       # rows of the broadcast table of frequent shingles
MAX_BROADCAST_BYTES = 32 << 20
_FLUSH = 2_000_000            # shingles a task holds before it counts them
_PART_BYTES = 2 << 20     # of texts whose shingles are made together
_TASK_SHINGLES = 1_500_000    # shingles that meet in one search task
_LEAD = 25                    # l is one of so many shingles of a set (at least 1)
_SHORT = 8                    # sets of a list whose pairs are counted
_MU = 0.01                    # cost of a probe against a heap step


def least_overlap(size: int, num: int, den: int) -> int:
    return -(-num * size // den)


def _count_frequent(k: int) -> Callable:
    """Shingles held by two or more different texts of a task, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total, seen = 0, set()

        def counted() -> pa.RecordBatch:
            tokens, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(count[often])], ["token", "n"])

        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                keys = part.column("key").to_pylist()
                new = [i for i, x in enumerate(keys) if x not in seen]
                seen.update(keys)
                if len(seen) > 1_000_000:
                    seen = set()
                part = part.take(pa.array(new, pa.int64()))
                tokens, _ = shingle_sets(texts_of(part), k)
                held.append(tokens)
                total += len(tokens)
                if total > _FLUSH:
                    yield counted()
                    held, total = [], 0
        if total:
            yield counted()
    return run


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and the bit length of their counts."""
    rows = docs.select(text_key(F.col("text")).alias("key"), "text").mapInArrow(giving_back(_count_frequent(k)), "token long, n long")
    top = (rows.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(MAX_COUNTED)
               .select("token", F.length(F.bin("n")).cast("byte").alias("bits")).toArrow())
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("bits").to_numpy()[order]


def _describe(k: int, num: int, den: int, frequent) -> Callable:
    """sig (128 bits of the sorted set), size and the rarest shingles."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = frequent.value
        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                tokens, sizes = shingle_sets(texts_of(part), k)
                rank = np.zeros(len(tokens), np.int8)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    rank = np.where(known[at] == tokens, bits[at], 0).astype(np.int8)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((mix64(tokens), rank, owner))
                begin = np.cumsum(sizes) - sizes
                place = np.arange(len(tokens)) - begin[owner]
                overlap = -(-num * sizes // den)
                wanted = np.where(sizes > 0, np.minimum(sizes, sizes - overlap + np.maximum(1, sizes // _LEAD)), 0)
                least = np.maximum(1, overlap // _LEAD)       # l of the smallest set it can link to
                keep = place < wanted[owner]
                prefix = tokens[order][keep].view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)
                sigs = [hashlib.blake2b(tokens[b:b + s].tobytes(), digest_size=16).digest() for b, s in zip(begin, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(least, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix))],
                    ["doc_id", "key", "sig", "size", "least", "prefix"])
    return run


def _sets(k: int) -> Callable:
    """The sets of wanted documents; a document that is repeated comes once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                sigs = part.column("sig").to_pylist()
                part = part.take(pa.array([i for i, x in enumerate(sigs) if x not in seen and not seen.add(x)], pa.int64()))
                tokens, sizes = shingle_sets(texts_of(part), k)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("grp"), part.column("sig"), part.column("meets"),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.view(np.int64)))],
                    ["grp", "node", "meets", "payload"])
    return run


def divide_skip(num: int, den: int) -> Callable:
    """Search of a group: ``sets`` (sorted shingle arrays) -> spanning links."""
    def search(sets: list[np.ndarray]) -> list[tuple[int, int]]:
        sizes = [len(s) for s in sets]
        forest = Forest(len(sets))
        # only shingles of two or more sets can be shared
        flat = np.concatenate(sets)
        _, dense, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[dense] > 1
        ends = np.cumsum(sizes)
        lists: dict[int, list[int]] = {}
        by_size = sorted(range(len(sets)), key=lambda i: (sizes[i], i))
        own: list = [None] * len(sets)
        trees, last = 0, -1                    # trees among the sets indexed so far

        def indexed(at: int) -> None:
            for t in own[at]:
                lists.setdefault(t, []).append(place)

        for place, x in enumerate(by_size):
            size = sizes[x]
            span = slice(ends[x] - size, ends[x])
            own[x] = dense[span][shared[span]].tolist()
            trees += 1
            need = least_overlap(size, num, den)
            # one tree so far: a link to any of it is all there is to find
            if trees == 2 and sizes[last] >= need:
                both = len(set(own[x]).intersection(own[last]))
                if both * den >= num * (size + sizes[last] - both):
                    forest.join(last, x)
                    trees = 1
                    indexed(x)
                    continue
            mine = sorted((lists[t] for t in own[x] if t in lists), key=len)
            if len(mine) >= need:
                longest = max(2, len(mine[-1]))
                n_long = min(need - 1, int(need / (_MU * np.log2(longest) + 1)))
                short, long = mine[:len(mine) - n_long], mine[len(mine) - n_long:]
                least = need - n_long
                at, run = -1, 0
                candidates = []
                for y in heapq.merge(*short):
                    if y == at:
                        run += 1
                    else:
                        if run >= least:
                            candidates.append((at, run))
                        at, run = y, 1
                if run >= least:
                    candidates.append((at, run))
                for y, both in candidates:
                    other = by_size[y]
                    if sizes[other] < need or forest.root(other) == forest.root(x):
                        continue
                    must = -(-num * (size + sizes[other]) // (num + den))
                    left = len(long)
                    for probed in long:
                        if both + left < must:
                            break
                        left -= 1
                        p = bisect_left(probed, y)
                        both += p < len(probed) and probed[p] == y
                    if both * den >= num * (size + sizes[other] - both):
                        forest.join(other, x)
                        trees -= 1
            indexed(x)
            last = x
        return forest.links
    return search


def _candidates(scratch: Scratch, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` that bring together all sets that may reach the overlap."""
    postings = classes.select("node", F.explode("prefix").alias("token"))
    sizes = postings.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    lists = scratch.write(postings.join(sizes, "token").join(classes.select("node", "least"), "node"), "lists")
    short, long = lists.where(F.col("n") <= _SHORT), lists.where(F.col("n") > _SHORT)
    n_long = long.groupBy("node").agg(F.count("*").alias("n_long"))
    # short lists: at most _SHORT ** 2 / 2 pairs each
    x, y = short.select("token", F.col("node").alias("a")), short.select("token", F.col("node").alias("b"))
    pairs = x.join(y, "token").where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    about = lists.groupBy("node").agg(F.first("least").alias("least")).join(n_long, "node", "left").select(
        "node", "least", F.coalesce("n_long", F.lit(0)).alias("n_long"))
    for end in ("a", "b"):
        pairs = pairs.join(about.select(F.col("node").alias(end), F.col("least").alias(f"least_{end}"),
                                        F.col("n_long").alias(f"long_{end}")), end)
    pairs = pairs.where(F.col("common") + F.least("long_a", "long_b") >= F.greatest("least_a", "least_b")).select("a", "b")
    # long lists: links to the smallest of those that could reach the overlap by long lists alone
    able = long.join(about.where("n_long >= least").select("node"), "node", "left_semi").select("token", "node")
    hubs = able.groupBy("token").agg(F.min("node").alias("hub"))
    stars = able.join(hubs, "token").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return pairs.unionByName(stars).distinct()


def link_documents(spark: SparkSession, docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                   name: str = "ngram") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, key, n_shingles,
    component_id, sig, root`` (key: the text's hash; root: the least ``sig`` of
    the component, which names it even where ids are null or repeated)."""
    scratch = Scratch(spark, name)
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, k))     # at most MAX_COUNTED rows
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    sets = scratch.write(keyed.mapInArrow(
        giving_back(_describe(k, num, den, frequent)),
        "doc_id long, key long, sig binary, size long, least long, prefix array<long>"), "sets")

    # classes of equal sets; ids of 64 bits are enough to bring sets together, links are verified
    classes = scratch.write(sets.where("size > 0").groupBy("sig").agg(
        F.min(F.struct("doc_id", "key")).alias("first"), F.min("doc_id").alias("least_id"), F.first("size").alias("size"),
        F.first("least").alias("least"), F.first("prefix").alias("prefix")).withColumn("node", F.xxhash64("sig")), "classes")
    stars = _candidates(scratch, classes)
    groups = scratch.write(components(scratch, stars, "near").select(F.col("node").alias("n64"), F.col("root").alias("grp")), "groups")
    scratch.drop("lists")

    members = classes.drop("node").withColumn("n64", F.xxhash64("sig")).join(groups, "n64").select(
        "grp", F.col("sig").alias("node"), F.col("size").alias("weight"), "first")
    wanted = scratch.write(deal(members, _TASK_SHINGLES).select(
        "grp", F.col("node").alias("sig"), "meets", F.col("first.doc_id").alias("want_id"), F.col("first.key").alias("want_key")), "wanted")
    texts = keyed.join(broadcast_if_small(wanted, 120 + 8 * F.size("meets"), MAX_BROADCAST_BYTES),
                       keyed["doc_id"].eqNullSafe(F.col("want_id")) & (keyed["key"] == F.col("want_key")))
    found = texts.select("grp", "sig", "meets", "text").mapInArrow(
        giving_back(_sets(k)), "grp long, node binary, meets array<struct<i:int,j:int>>, payload array<long>")
    links = scratch.write(spanning_links(found, divide_skip(num, den)).where("a <> b"), "links")
    scratch.drop("wanted", "groups")
    labels = components(scratch, links, "linked")

    named = classes.select("sig", "least_id").join(labels.withColumnRenamed("node", "sig"), "sig")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = named.join(least, "root").select("sig", "component_id", "root")
    of_class = scratch.write(classes.join(linked, "sig", "left").select(
        "sig", F.coalesce("component_id", "least_id").alias("component_id"), F.coalesce("root", "sig").alias("root")), "of_class")
    scratch.drop("classes", "links")
    rows = sets.select("doc_id", "key", "sig", F.col("size").alias("n_shingles"))
    joined = rows.where("n_shingles > 0").join(of_class, "sig", "left").select(
        "doc_id", "key", "n_shingles", "component_id", "sig", "root")
    return joined.unionByName(rows.where("n_shingles = 0").select(
        "doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), "sig", F.col("sig").alias("root")))


def keep_one(spark: SparkSession, docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest
    id (then the smallest text hash). Documents without words all stay."""
    linked = link_documents(spark, docs, k, num, den, "keep_one")
    i, x = fresh(docs, "keep_id"), fresh(docs, "keep_key")
    empty = linked.where("n_shingles = 0").select(F.col("doc_id").alias(i), F.col("key").alias(x), F.lit(True).alias("all_copies"))
    first = (linked.where("n_shingles > 0 AND doc_id <=> component_id")
             .groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("copies"))
             .select(F.col("first.doc_id").alias(i), F.col("first.key").alias(x), (F.col("copies") < 2).alias("all_copies")))
    keep = Scratch(spark, "keep_one").write(first.unionByName(empty.distinct()), "keep")
    flag = fresh(docs, "all_copies")
    match = docs["doc_id"].eqNullSafe(F.col(i)) & (text_key(docs["text"]) == F.col(x))
    kept = docs.join(keep.withColumnRenamed("all_copies", flag), match)
    once = kept.where(F.col(flag)).select(*docs.columns)
    if keep.where("NOT all_copies").isEmpty():
        return once
    # rows repeated in full: one of them stays
    again = kept.where(~F.col(flag)).dropDuplicates([i, x]).select(*docs.columns)
    return once.unionByName(again)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return link_documents(spark, docs, 3, 90, 100, "op10").select("doc_id", "n_shingles", "component_id")
