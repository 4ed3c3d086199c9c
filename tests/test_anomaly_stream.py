"""The anomaly profile of a stream for any cut into batches."""

import json

import pytest
from pyspark.sql import functions as F

from meterbill.operators import quality as Q
from meterbill.sources.cdr import decode_cdr
from meterbill.streaming import anomalies as SN
from tests_support import rec


def records():
    """Two source partitions with repeated, late, broken and untimed records."""
    out = []
    for p in (0, 1):
        for n in range(40):
            r = rec((n * 7 + p) % 60, caller=f"2126{p}{n % 25:07d}", duration=-1 if n % 11 == 0 else 60)
            if n % 9 == 0:
                r["timestamp"] = None if n % 2 else "garbage"
            if n % 13 == 0:
                r["record_type"] = "ping"
            out.append((p, 100 + n, out[-3][2] if n % 6 == 5 else json.dumps(r)))
    return out


@pytest.mark.parametrize("cuts", [[0, 40], [0, 1, 2, 20, 40], list(range(0, 41, 5))])
def test_equals_the_batch_profile(spark, scratch, cuts, monkeypatch):
    monkeypatch.setattr(Q, "ARRIVAL_BLOCK", 16)
    rows = records()
    schema = "source_partition int, offset long, value string"
    everything = spark.createDataFrame(rows, schema)
    want = Q.anomaly_profile(decode_cdr(everything, keep=("offset", "source_partition")), "offset", "source_partition").first()
    assert want["out_of_order"] > 3 and want["duplicates"] > 5 and want["unknown_types"] > 1
    out, ckpt = scratch("profile"), scratch("ckpt")
    spark.createDataFrame([("q1",)], "id string").coalesce(1).write.json(f"{ckpt}/metadata")
    write = SN.profile_batch_writer(out, ckpt, "offset", "source_partition")
    assert SN.stream_anomaly_profile(spark, out).first()["total_records"] == 0
    pieces = [(n, [r for r in rows if 100 + a <= r[1] < 100 + b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    for n, piece in reversed(pieces):                     # the order in which batches run does not matter
        write(spark.createDataFrame(piece, schema), n)
    write(spark.createDataFrame(pieces[0][1], schema), 0)  # a batch is replayed
    assert SN.stream_anomaly_profile(spark, out).first() == want


def test_stream_goes_on_after_a_restart(spark, scratch):
    rows = [r for r in records() if r[0] == 0]
    log, out, ckpt = scratch("log"), scratch("profile"), scratch("ckpt")
    for n, part in enumerate((rows[:15], rows[15:])):
        df = spark.createDataFrame([(o, v) for _, o, v in part], "offset long, value string")
        df.coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(df.schema).parquet(log)
        SN.start_anomaly_profile(stream, out, ckpt, available_now=True).awaitTermination()
        seen = spark.read.parquet(log)
        assert SN.stream_anomaly_profile(spark, out).first() == Q.anomaly_profile(decode_cdr(seen, keep=("offset",))).first()
    assert seen.agg(F.count("*")).first()[0] == 40
