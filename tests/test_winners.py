"""Streams whose result does not depend on arrival order, with bounded state and accounts."""

import itertools
import json
import time

from pyspark.sql import functions as F

from meterbill.plans.jobs import run_mediation
from meterbill.sources.cdr import read_cdr_stream
from meterbill.streaming import winners as SW
from meterbill.streaming.mediation import WRITERS_A_DATE
from tests_support import rec, write_log


def deliver(spark, log, out, ckpt, **options):
    q = SW.start_winners(read_cdr_stream(spark, "text", log, maxFilesPerTrigger="1"), out, ckpt, available_now=True, **options)
    q.awaitTermination()
    return q


def rows(df):
    return sorted(map(str, df.collect()))


def batch(spark, records):
    return rows(run_mediation(spark.createDataFrame([(json.dumps(r),) for r in records], "value string")))


def test_every_order_of_conflicting_copies(spark, scratch):
    """An error copy, two ok copies that differ, and an untimed pair, one file each."""
    copies = [rec(1, duration=-5), rec(1, duration=60), rec(1, duration=50)]
    untimed = {**rec(2), "timestamp": "garbage"}
    want = batch(spark, [*copies, untimed, untimed])
    assert len(want) == 2 and "duration_sec=50" in "".join(want)
    for order in itertools.permutations(copies):
        log, out = scratch("log"), scratch("out")
        for n, r in enumerate(order):
            write_log(spark, f"{log}/day={n}", [r, untimed])
        deliver(spark, log, out, scratch("ckpt"))
        assert rows(SW.read_winners(spark, out)) == want


def test_nothing_survives(spark, scratch):
    log, out = scratch("log"), scratch("out")
    assert SW.read_winners(spark, out).count() == 0
    write_log(spark, f"{log}/day=1", [rec(1, duration=-5)])
    deliver(spark, log, out, scratch("ckpt"))
    assert SW.read_winners(spark, out).count() == 0


def test_state_is_bounded_and_no_row_is_lost(spark, scratch):
    """Five deliveries, each with new records, one late, and a copy of the very
    first: the state holds about one delivery, the result is the batch result."""
    log, out, ckpt = scratch("log"), scratch("out"), scratch("ckpt")
    everything, held = [], []
    for n in range(5):
        records = [rec(s, caller=f"2126{n:08d}") for s in range(20)] + [rec(0, caller="212600000000"),
                   {**rec(1, caller=f"2127{n:08d}"), "timestamp": "2020-01-05T10:00:00.000000Z"}]
        records += records[:3]
        everything += records
        write_log(spark, f"{log}/day={n}", records)
        q = deliver(spark, log, out, ckpt, delay="1 second")
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) == 0
        time.sleep(1.5)
    assert max(held) <= 2 * 22 < 5 * 21, held                # two deliveries at most; all would be 106
    assert rows(SW.read_winners(spark, out)) == batch(spark, everything)
    # copies within a delivery were dropped by the state, those further apart are stored and lose
    assert SW.read_versions(spark, out).where("record_hash IS NOT NULL").count() >= len(batch(spark, everything))


def test_accounts_add_up_and_replays_do_not_double(spark, scratch):
    log, out, ckpt = scratch("log"), scratch("out"), scratch("ckpt")
    write_log(spark, f"{log}/day=0", [rec(s) for s in range(10)] + [rec(3), rec(4, duration=-1)])
    write_log(spark, f"{log}/day=1", [rec(3), rec(11, caller="33600000000"), {**rec(12), "timestamp": "garbage"},
                                      {**rec(13), "timestamp": "2024-01-05T01:00:00.000000Z"}, rec(20)])
    deliver(spark, log, out, ckpt, accounting=True)
    per_batch = {r["batch_id"]: r.asDict() for r in SW.read_accounts(spark, out).collect()}
    assert [per_batch[0][c] for c in ("decoded", "rejected", "repeated", "stored", "untimed", "late")] == [12, 1, 1, 10, 0, 0]
    assert [per_batch[1][c] for c in ("decoded", "rejected", "repeated", "stored", "untimed", "late")] == [5, 1, 0, 4, 1, 1]
    total = tuple(SW.account_totals(spark, out).first())
    assert total == (17, 2, 2, 13, 1) and total[0] == sum(total[1:4])
    writer = SW.winner_batch_writer(out, ckpt, accounting=True)
    again = SW.checked(spark.read.text(f"{log}/day=1"))
    writer(again, 1)                                          # as after a failure
    assert tuple(SW.account_totals(spark, out).first()) == total


def test_arrival_and_event_folders(spark, scratch):
    log, out = scratch("log"), scratch("out")
    write_log(spark, f"{log}/day=0", [rec(1), {**rec(2), "timestamp": None}])
    deliver(spark, log, out, scratch("ckpt"))
    versions = SW.read_versions(spark, out)
    assert {str(r["event_date"]) for r in versions.collect()} == {"2024-01-05", "None"}
    assert versions.where(F.col("arrival_date") >= F.date_sub(F.current_date(), 1)).count() == 2
    dates = versions.select("event_date").distinct()
    assert "ReadSchema: struct<>" in dates._jdf.queryExecution().executedPlan().toString()


def test_a_stream_with_state_writes_few_files_a_date(spark, scratch):
    """Adaptive execution is off for its batches, so a rebalance hint does nothing there."""
    log, out = scratch("log"), scratch("out")
    records = [{**rec(s), "timestamp": f"2024-01-{d:02d}T10:00:{s:02d}.000000Z"} for d in (5, 6, 7) for s in range(40)]
    write_log(spark, f"{log}/day=0", records)
    deliver(spark, log, out, scratch("ckpt"), delay="1 second")
    assert rows(SW.read_winners(spark, out)) == batch(spark, records)
    files = SW.read_versions(spark, out).select("event_date", F.input_file_name().alias("f")).distinct().groupBy("event_date").count()
    assert 0 < max(r["count"] for r in files.collect()) <= WRITERS_A_DATE
