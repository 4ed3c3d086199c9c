"""Connected groups from links, without all pairs and without big groups in
one task.

``components`` labels the nodes of an edge table by alternating large and
small stars. ``spanning_links`` searches groups of rows for links: a group
above a size limit is cut into chunks and every two chunks meet in a task of
their own, so all pairs of a group are covered while no task holds more than
the limit, and each task returns a spanning forest of its links, not all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, giving_back


class Forest:
    """Union-find over 0..n-1 that remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))


_FOREST_EDGES = 500_000   # edges that a task holds before it reduces them


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task replaced by stars of their local components."""
    held: list[pa.RecordBatch] = []

    def reduced() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        both = pa.concat_arrays([c for x in ("a", "b") for c in table.column(x).chunks]).dictionary_encode()
        ids, n = both.indices.to_numpy(), table.num_rows
        forest = Forest(len(both.dictionary))
        for i, j in zip(ids[:n].tolist(), ids[n:].tolist()):
            forest.join(i, j)
        nodes = np.arange(len(both.dictionary))
        roots = np.array([forest.root(i) for i in nodes.tolist()], np.int64)
        keep = np.flatnonzero(nodes != roots)
        return pa.RecordBatch.from_arrays(
            [both.dictionary.take(pa.array(keep)), both.dictionary.take(pa.array(roots[keep]))], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > _FOREST_EDGES:
            yield reduced()
            held = []
    if held:
        yield reduced()


def _down(e: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return (e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _all_stars(e: DataFrame) -> bool:
    """True when every node has one edge down, or is the end of some."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        e.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    degrees = ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return degrees.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def components(scratch: Scratch, edges: DataFrame, name: str = "cc") -> DataFrame:
    """``node, root``: the smallest node of its component, for every node of
    ``edges`` (a, b; any orderable type). An empty table gives an empty one."""
    kind = dict(edges.dtypes)["a"]
    now = scratch.write(_down(edges.select("a", "b").mapInArrow(giving_back(_local_forest), f"a {kind}, b {kind}")), f"{name}0")
    turn = 0
    while not _all_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        turn += 1
        now = scratch.write(_down(stars.unionByName(small.select("a", F.col("m").alias("b")))), f"{name}{turn}")
        scratch.drop(f"{name}{turn - 1}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def deal(members: DataFrame, limit: int) -> DataFrame:
    """Where each member meets the others of its group: ``members`` (grp, node,
    weight, ...) of groups of two or more, with ``meets``, an array of (i, j).

    A group of at most ``limit`` weight meets as a whole in (0, 0); of a larger
    one every two chunks (i, j) of about half that weight meet."""
    totals = members.groupBy("grp").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).where("n > 1")
    totals = totals.select("grp", F.when(F.col("w") <= limit, 1).otherwise(
        F.ceil(2 * F.col("w") / limit).cast("int")).alias("parts"))
    chunk = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    meets = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("chunk")),
                    lambda o: F.struct(F.least(o, F.col("chunk")).alias("i"), F.greatest(o, F.col("chunk")).alias("j"))))
    return members.join(totals, "grp").withColumn("chunk", chunk).withColumn("meets", meets).drop("chunk", "parts")


_HELD_PAIRS, _HELD_CHARS = 32_768, 16 << 20   # groups of two that are judged together


def spanning_links(dealt: DataFrame, search: Callable[[list], list[tuple[int, int]]],
                   pairs: Callable[[list[tuple]], np.ndarray] | None = None) -> DataFrame:
    """Links ``a, b`` between the ``node`` values that meet: ``dealt`` holds
    grp, node, payload and ``meets``. ``search(payloads)`` returns links between
    positions that span the components of what it is given; ``pairs`` tells of many
    groups of two at once which of them link."""
    kind = dict(dealt.dtypes)["node"]
    rows = dealt.select("grp", "node", "payload", F.explode("meets").alias("meet")).select("grp", "meet.i", "meet.j", "node", "payload")
    return (rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
            .mapInArrow(giving_back(_search_runs(search, pairs)), f"a {kind}, b {kind}").distinct())


def _search_runs(search: Callable, pairs: Callable | None = None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, payloads, kind = None, [], [], None
        a: list = []
        b: list = []
        two: list[tuple] = []
        ends: list[tuple] = []
        held = 0

        def settle() -> None:
            nonlocal held
            for (x, y), linked in zip(ends, pairs(two) if two else ()):
                if linked:
                    a.append(x)
                    b.append(y)
            two.clear()
            ends.clear()
            held = 0

        def close() -> None:
            nonlocal held
            if len(nodes) == 2 and pairs:
                two.append((payloads[0], payloads[1]))
                ends.append((nodes[0], nodes[1]))
                held += len(payloads[0]) + len(payloads[1])
                if len(two) >= _HELD_PAIRS or held > _HELD_CHARS:
                    settle()
            elif len(nodes) > 1:
                for i, j in search(payloads):
                    a.append(nodes[i])
                    b.append(nodes[j])

        for batch in batches:
            kind = batch.column("node").type
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("grp", "i", "j"))))
            ids = batch.column("node").to_pylist()
            values = batch.column("payload")
            if pa.types.is_list(values.type):
                flat, off = values.values.to_numpy(), values.offsets.to_numpy()
                values = [flat[x:y] for x, y in zip(off[:-1], off[1:])]
            else:
                values = values.to_pylist()
            for k, node, value in zip(keys, ids, values):
                if k != key:
                    close()
                    key, nodes, payloads = k, [], []
                nodes.append(node)
                payloads.append(np.array(value) if isinstance(value, np.ndarray) else value)
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])
                a, b = [], []
        close()
        settle()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])
    return run
