"""Results kept by what they mean, not by a name.

The key of a result is its plan's semantics (arguments are part of it) and the
files that it reads: an equal query built anew hits, one over a table that has
grown since misses and replaces the old result. Results live on the executors;
the least recently used go when all together pass a size bound, any after
``ttl_s`` seconds.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections import OrderedDict

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def files_of(df: DataFrame) -> str:
    """Digest of the files that ``df`` reads, also while an equal plan is kept.
    Spark never rewrites a file in place, so files that are the same by name
    are the same. A source without files counts by its description."""
    names, todo = [], [df._jdf.queryExecution().analyzed()]
    while todo:
        plan = todo.pop()
        inner = [*_each(plan.children()), *_each(plan.subqueries())]
        if not inner and plan.getClass().getSimpleName() == "LogicalRelation" and hasattr(plan.relation(), "location"):
            names += list(plan.relation().location().inputFiles())
        elif not inner:
            names.append(re.sub(r"#\d+L?", "", plan.toString()))
        todo += inner
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def _each(seq) -> list:
    return [seq.apply(n) for n in range(seq.size())]


def size_of(df: DataFrame) -> int:
    """Bytes of a kept result once it is built; before that, the plan's estimate."""
    return int(str(df._jdf.queryExecution().withCachedData().stats().sizeInBytes()))


class ResultCache:
    def __init__(self, max_bytes: int = 4 << 30, ttl_s: float = 300.0, clock=time.monotonic):
        self.max_bytes, self.ttl_s, self.clock = max_bytes, ttl_s, clock
        self._held: OrderedDict[int, list[tuple[DataFrame, str, float]]] = OrderedDict()
        self.hits = self.misses = 0

    def get(self, df: DataFrame) -> DataFrame:
        """``df``, or the kept result of an equal query over the same files."""
        key, files, now = df.semanticHash(), files_of(df), self.clock()
        for held in list(self._held.get(key, ())):
            same = held[0].sameSemantics(df)             # hashes may collide
            if same and held[1] == files and now - held[2] < self.ttl_s:
                self._held.move_to_end(key)
                self.hits += 1
                return held[0]
            if same:
                self._drop(key, held)
        self.misses += 1
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._held.setdefault(key, []).append((kept, files, now))
        self._held.move_to_end(key)
        self._shrink()
        return kept

    def _drop(self, key: int, held: tuple) -> None:
        held[0].unpersist()
        self._held[key].remove(held)
        if not self._held[key]:
            del self._held[key]

    def total_bytes(self) -> int:
        return sum(size_of(h[0]) for several in self._held.values() for h in several)

    def _shrink(self) -> None:
        """Release the least recently used results, but not the one just asked for."""
        while len(self._held) > 1 and self.total_bytes() > self.max_bytes:
            key, several = next(iter(self._held.items()))
            for held in list(several):
                self._drop(key, held)

    def clear(self) -> None:
        for key, several in list(self._held.items()):
            for held in list(several):
                self._drop(key, held)
