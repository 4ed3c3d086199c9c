import json

from pyspark.sql import functions as F

from meterbill.operators import mediation as M
from meterbill.operators import quality as Q
from meterbill.operators.rating import unprocessed
from meterbill.schemas import RAW_CDR
from meterbill.sources.cdr import decode_cdr


def raw_frame(spark, records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return decode_cdr(spark.createDataFrame(rows, "offset long, value string"), keep=("offset",))


VOICE = {"record_type": "voice", "timestamp": "2024-01-05T10:00:00.000000Z", "caller_id": "212600000001",
         "callee_id": "212600000002", "duration_sec": 60, "cell_id": "RABAT_01", "technology": "4G"}


def test_decode_is_permissive(spark):
    df = decode_cdr(spark.createDataFrame([('{"record_type": "sms", "duration_sec": "abc"}',), ("not json",)],
                                          "value string"))
    rows = df.collect()
    assert df.columns == RAW_CDR.fieldNames()
    assert rows[0]["record_type"] == "sms" and rows[0]["duration_sec"] is None
    assert all(v is None for v in rows[1])


def test_parties_priority(spark):
    recs = [{"caller_id": "c", "sender_id": "s", "user_id": "u", "callee_id": "x", "receiver_id": "y"},
            {"sender_id": "s", "user_id": "u", "receiver_id": "y"},
            {"user_id": "u"}]
    got = M.normalize_parties(raw_frame(spark, recs)).orderBy("offset").select("msisdn", "peer_id").collect()
    assert [tuple(r) for r in got] == [("c", "x"), ("s", "y"), ("u", None)]


def test_status_branches(spark):
    base = dict(VOICE)
    cases = {
        "null": {**base, "caller_id": None},
        "prefix33": {**base, "caller_id": "33612345678"},
        "blocked": {**base, "caller_id": "999000000000"},
        "negative_duration": {**base, "duration_sec": -1},
        "negative_volume": {"record_type": "data", "timestamp": base["timestamp"], "user_id": "212600000001",
                            "data_volume_mb": -0.5, "session_duration_sec": 10},
        "null_measures_ok": {"record_type": "voice", "timestamp": base["timestamp"], "caller_id": "212600000009"},
        "prefix_match_only": {**base, "caller_id": "212abc"},
        "ok": base,
    }
    names = list(cases)
    df = M.validate(M.normalize_parties(raw_frame(spark, [cases[n] for n in names])))
    got = {names[r["offset"]]: (r["status"]) for r in df.select("offset", "status").collect()}
    assert got == {"null": "error", "prefix33": "error", "blocked": "error", "negative_duration": "error",
                   "negative_volume": "error", "null_measures_ok": "ok", "prefix_match_only": "error",
                   "ok": "ok"}
    reasons = {names[r["offset"]]: r["r"] for r in
               M.normalize_parties(raw_frame(spark, [cases[n] for n in names]))
               .select("offset", M.reject_reason().alias("r")).collect()}
    assert reasons["null"] == "null_msisdn" and reasons["prefix33"] == "bad_prefix"
    assert reasons["blocked"] == "bad_prefix"          # 999... never starts with 212
    assert reasons["negative_duration"] == "negative_measure" and reasons["ok"] is None


def test_hash_skips_null_parts(spark):
    import hashlib
    df = M.with_record_hash(M.normalize_parties(raw_frame(spark, [{**VOICE, "caller_id": None}, VOICE])))
    got = {r["offset"]: r["record_hash"] for r in df.collect()}
    assert got[0] == hashlib.sha256(f"{VOICE['timestamp']}|voice".encode()).hexdigest()
    assert got[1] == hashlib.sha256(f"{VOICE['timestamp']}|212600000001|voice".encode()).hexdigest()


def test_dedup_prefers_ok_and_is_deterministic(spark):
    bad = {**VOICE, "duration_sec": -5}          # same hash as VOICE, status error
    later = {**VOICE, "duration_sec": 90}        # same hash, ok, larger duration
    for order in ([bad, VOICE, later], [later, bad, VOICE], [VOICE, later, bad]):
        out = M.mediate_all(raw_frame(spark, order)).collect()
        assert len(out) == 1
        assert out[0]["status"] == "ok" and out[0]["duration_sec"] == 60


def test_dedup_runs_before_the_filter(spark):
    # an error row alone keeps its hash; after the filter nothing is left
    out = M.mediate(raw_frame(spark, [{**VOICE, "duration_sec": -5}, {**VOICE, "duration_sec": -5}]))
    assert out.count() == 0


def test_project_casts_timestamp_safely(spark):
    out = M.mediate(raw_frame(spark, [VOICE, {**VOICE, "caller_id": "212600000003", "timestamp": "garbage"}]))
    rows = {r["msisdn"]: r["timestamp"] for r in out.collect()}
    assert rows["212600000003"] is None
    assert str(rows["212600000001"]) == "2024-01-05 10:00:00"
    assert out.columns == ["record_type", "timestamp", "msisdn", "peer_id", "duration_sec", "data_volume_mb",
                           "session_duration_sec", "cell_id", "technology", "status", "record_hash"]


def test_dedup_hot_key_uses_partial_aggregation(spark):
    """One hash holding a third of all rows: combined map-side, exact result."""
    hot = [dict(VOICE) for _ in range(300)]
    cold = [{**VOICE, "caller_id": f"2127{i:08d}"} for i in range(600)]
    df = raw_frame(spark, hot + cold).repartition(8)
    out = M.mediate_all(df)
    assert out.count() == 601
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_anomaly_profile_counts(spark):
    recs = [VOICE, dict(VOICE),                                            # one duplicate
            {**VOICE, "caller_id": "abcde", "timestamp": "2024-01-05T09:00:00.000000Z"},  # corrupted + early
            {**VOICE, "record_type": "ping", "caller_id": "212600000005"},  # unknown type
            {"record_type": "sms", "timestamp": "2024-01-05T11:00:00.000000Z", "sender_id": "212600000006",
             "cell_id": "X", "technology": "4G"}]                          # missing receiver
    row = Q.anomaly_profile(raw_frame(spark, recs)).collect()[0]
    assert row["total_records"] == 5
    assert row["duplicates"] == 1
    assert row["corrupted_values"] == 1
    assert row["unknown_types"] == 1
    assert row["missing_fields"] == 1
    assert row["out_of_order"] == 1


def test_out_of_order_across_blocks(spark, monkeypatch):
    """Block-wise lag equals a global lag, also across block boundaries."""
    monkeypatch.setattr(Q, "ARRIVAL_BLOCK", 4)
    ts = [1, 2, 3, 9, 4, 5, 6, 7, 2, 8, 8, 1, 10]
    recs = [{**VOICE, "timestamp": f"2024-01-05T10:00:{t:02d}.000000Z"} for t in ts]
    got = Q.out_of_order_count(raw_frame(spark, recs)).collect()[0][0]
    expected = sum(1 for a, b in zip(ts, ts[1:]) if b < a)
    assert got == expected


def test_ttl_cache_refreshes_after_expiry(spark):
    from meterbill.sources.tables import TtlCache
    now = [0.0]
    loads = []

    def loader():
        loads.append(1)
        return spark.range(len(loads))
    c = TtlCache(loader, ttl_s=300, clock=lambda: now[0])
    assert c.get().count() == 1 and c.get().count() == 1 and len(loads) == 1
    assert c.get().is_cached
    now[0] = 299.0
    assert c.get().count() == 1
    now[0] = 300.0
    assert c.get().count() == 2 and len(loads) == 2


def test_out_of_order_per_source_partition(spark, monkeypatch):
    """Offsets restart in every source partition; order is checked within each."""
    monkeypatch.setattr(Q, "ARRIVAL_BLOCK", 3)
    streams = {0: [1, 5, 2, 6, 7, 3, 8], 1: [9, 1, 2, 3, 0, 4]}
    rows = []
    for p, ts in streams.items():
        for off, t in enumerate(ts):
            rows.append((p, off, json.dumps({**VOICE, "timestamp": f"2024-01-05T10:00:{t:02d}.000000Z"})))
    df = decode_cdr(spark.createDataFrame(rows, "partition int, offset long, value string"),
                    keep=("partition", "offset"))
    got = Q.out_of_order_count(df, "offset", "partition").collect()[0][0]
    want = sum(1 for ts in streams.values() for a, b in zip(ts, ts[1:]) if b < a)
    assert got == want


def test_declared_driver_schemas_match_files(spark):
    import os
    from meterbill.sources.fixtures import DRIVER_SCHEMAS
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        for name, schema in DRIVER_SCHEMAS.items():
            path = f"/root/testdata/{sf}/{name}.parquet"
            if os.path.exists(path):
                assert spark.read.parquet(path).schema.simpleString() == schema.simpleString(), (sf, name)


def test_shared_folder_is_required_on_a_cluster():
    import pytest
    from meterbill.session import checkpoint_root

    class Conf:
        def __init__(self, **kv):
            self.kv = kv

        def get(self, key, default=None):
            return self.kv.get(key, default)

    class Session:
        conf = Conf(**{"spark.master": "spark://host:7077"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    Session.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///ckpt/"})
    assert checkpoint_root(Session()) == "hdfs:///ckpt"


def test_scratch_folders_are_deleted(spark, tmp_path, monkeypatch):
    import os
    from meterbill import session
    monkeypatch.setattr(session, "_SCRATCH", [f"file://{tmp_path}/a"])
    spark.range(3).write.parquet(f"file://{tmp_path}/a")
    session.drop_scratch(spark.sparkContext._gateway.jvm)
    assert not os.path.exists(tmp_path / "a")


def test_no_decoding_in_a_filter_at_the_scan(spark):
    """A join on the hash must not send "is not null" of it, decoding and all, below the shuffle of the messages."""
    raw = spark.createDataFrame([(i, json.dumps({**VOICE, "duration_sec": i})) for i in range(4)], "offset long, value string").repartition(2, "offset")
    normalized = M.mediate(decode_cdr(raw, keep=("offset",)))
    new = unprocessed(normalized, normalized.where("duration_sec > 5"))
    filters = [line for line in new._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)
    assert new.count() == 1 and not normalized.schema["record_hash"].nullable
