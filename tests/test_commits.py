"""Repeatable appends and the bucketed rated history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.operators import rating as RT
from meterbill.schemas import NORMALIZED_CDR, RATED_CDR
from meterbill.sources import commits as C
from meterbill.sources.rated_store import RatedStore

SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("m", T.IntegerType())])


def rows(spark, path):
    return sorted((r["x"], r["run"]) for r in C.read_committed(spark, path, SCHEMA).collect())


def test_a_run_counts_once(spark, scratch):
    path = scratch("runs")
    assert C.read_committed(spark, path, SCHEMA).count() == 0
    df = spark.range(3).select(F.col("id").alias("x"), (F.col("id") % 2).cast("int").alias("m"))
    assert C.append_run(df, path, "a", ["m"]) and not C.append_run(df, path, "a", ["m"])
    assert C.append_run(df.limit(1), path, "b", ["m"])
    assert rows(spark, path) == [(0, "a"), (0, "b"), (1, "a"), (2, "a")]
    assert C.committed_runs(spark, path) == ["a", "b"]
    one = C.read_committed(spark, path, SCHEMA).where("m = 1")
    assert all("m=1" in f for f in one.inputFiles()) or one.count() == 1


def test_killed_between_write_and_commit(spark, scratch, monkeypatch):
    path = scratch("runs")
    df = spark.range(5).select(F.col("id").alias("x"), F.lit(1).alias("m"))
    C.append_run(df.limit(2), path, "before")

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(C, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        C.append_run(df, path, "a")
    monkeypatch.undo()
    assert len(rows(spark, path)) == 2                       # the rows are there, but do not count
    assert spark.read.parquet(f"{path}/run=a").count() == 5
    assert C.append_run(df.where("x < 4"), path, "a")         # the rerun replaces them
    assert [x for x, r in rows(spark, path) if r == "a"] == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        C.discard(spark, path, "a")
    with pytest.raises(ValueError):
        C.append_run(df, path, "../a")


def rated(spark, hashes, month):
    base = spark.createDataFrame([(h, dt.datetime(2024, month, 5, 10)) for h in hashes], "record_hash string, timestamp timestamp")
    return base.select(*[F.col(f.name) if f.name in ("record_hash", "timestamp") else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in RATED_CDR.fields])


def normalized(spark, hashes, month):
    rows = [(h, dt.datetime(2024, month, 5, 10), "ok", dt.date(2024, month, 5), dt.date(2024, 3, 1)) for h in hashes]
    base = spark.createDataFrame(rows, "record_hash string, timestamp timestamp, status string, event_date date, arrival_date date")
    return base.select(*[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in NORMALIZED_CDR.fields], "event_date", "arrival_date")


def test_rated_store_is_joined_without_a_shuffle(spark, scratch):
    store = RatedStore(spark, "rated_store_test", scratch("rated"), buckets=4)
    old = [f"h{i}" for i in range(400)]
    assert store.append(rated(spark, old[:200], 1), "january") and store.append(rated(spark, old[200:], 2), "february")
    assert not store.append(rated(spark, ["again"], 1), "january")
    assert store.read().count() == 400
    new = normalized(spark, old[190:260] + ["n1", "n2"], 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = RT.unprocessed(new, store.read(), arrived_since=dt.date(2024, 2, 1))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan     # the new records alone
        assert "Bucketed: true" in plan
        got = {r["record_hash"] for r in out.collect()}
        # a copy has its record's month, so hashes of other months are not looked for
        assert got == {f"h{i}" for i in range(190, 200)} | {"n1", "n2"}
        scan = next(x for x in plan.split("\n") if "rated_store_test" in x)
        assert "usage_month" in scan.split("PartitionFilters")[1].split("]")[0], scan
        assert scan.split("ReadSchema")[1].startswith(": struct<record_hash:string>"), scan
        read = store.read().where("usage_month = DATE'2024-02-01'").select(F.input_file_name().alias("f")).distinct().collect()
        assert len(read) == 4 and all("usage_month=2024-02-01" in r["f"] for r in read)   # none of January
        every = RT.unprocessed(new, store.read())
        assert {r["record_hash"] for r in every.collect()} == {"n1", "n2"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rated_store_in_another_session(spark, scratch):
    path = scratch("rated")
    RatedStore(spark, "rated_store_one", path, buckets=2).append(rated(spark, ["a", "b"], 1), "r1")
    spark.sql("DROP TABLE rated_store_one")                           # an external table: the files stay
    again = RatedStore(spark, "rated_store_two", path, buckets=2)
    assert sorted(r["record_hash"] for r in again.read().collect()) == ["a", "b"]
    assert again.append(rated(spark, ["c"], 2), "r2") and again.read().count() == 3


def test_killed_store_append_is_repeated(spark, scratch, monkeypatch):
    from meterbill.sources import rated_store as S
    store = RatedStore(spark, "rated_store_killed", scratch("rated"), buckets=2)
    store.append(rated(spark, ["a"], 1), "r1")

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(S, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        store.append(rated(spark, ["b", "c"], 1), "r2")
    monkeypatch.undo()
    assert store.read().count() == 1
    assert store.append(rated(spark, ["b"], 1), "r2")
    assert sorted(r["record_hash"] for r in store.read().collect()) == ["a", "b"]


def test_records_are_made_once_for_all_attempts(spark):
    """sink_append_once: every attempt reads the stored records, none makes them again."""
    from types import SimpleNamespace

    from meterbill.plans.catalog import REGISTRY
    made = spark.sparkContext.accumulator(0)
    blank = (None,) * (len(NORMALIZED_CDR) - 1)

    def record(n):
        made.add(1)
        return dict(zip((f.name for f in NORMALIZED_CDR if f.name != "record_hash"), blank)) | {"record_hash": f"h{n}"}
    frame = spark.createDataFrame(spark.sparkContext.parallelize(range(40), 2).map(record), NORMALIZED_CDR)
    got = REGISTRY["sink_append_once"](SimpleNamespace(spark=spark, normalized=frame))
    assert sorted(r["record_hash"] for r in got.collect()) == sorted(f"h{n}" for n in range(40))
    assert made.value == 40
