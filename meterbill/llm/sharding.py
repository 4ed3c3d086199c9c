"""Sharding by a permutation-filled lookup table.

Every shard walks its own permutation of the slots of a prime-sized table
(offset and skip from two hashes of its name). Shards take turns; on its turn
a shard claims the next slot of its permutation that is still free, until the
table is full. A row's shard is the table's entry at ``hash(key) mod size``:
one lookup, shards of nearly equal size, and when a shard joins or leaves few
other rows move.

Defined cases: a null key is placed by the key ''. Equal keys get the same
shard (a hot key stays whole). An empty table gives an empty result. Columns
named ``slot`` or ``shard`` in the input are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_SHARDS = 256
TABLE_SIZE = 65537


def _number(text: str) -> int:
    """60-bit number of a text; the same in Spark SQL (see ``slot_of``)."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Index into ``shards`` for each of ``size`` slots. ``size`` is prime, so
    every skip visits all slots; it bounds the table, whatever the data."""
    if not is_prime(size):
        raise ValueError("size must be a prime")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most size")
    at = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table = np.full(size, -1, np.int64)
    free = size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size


def assign_shards(spark: SparkSession, df: DataFrame, key: str, shards: list[str] | None = None,
                  size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``. The table has ``size`` rows and is
    broadcast; ``df`` is neither shuffled nor sorted."""
    shards = shards or [f"shard-{i:05d}" for i in range(N_SHARDS)]
    table = lookup_table(shards, size)
    rows = list(zip(range(size), [shards[i] for i in table]))
    lookup = spark.createDataFrame(rows, "slot long, shard string")
    return (df.drop("shard").withColumn("slot", slot_of(F.col(key), size))
              .join(F.broadcast(lookup), "slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard. A big shard is written by several tasks: rows are
    rebalanced by shard, which splits large partitions."""
    df.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return assign_shards(spark, docs, "doc_id").select("doc_id", "slot", "shard")
