"""Message logs for stream tests."""

import json


def write_log(spark, path, records):
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def rec(second, caller="212600000001", duration=60):
    return {"record_type": "voice", "timestamp": f"2024-01-05T10:00:{second:02d}.000000Z", "caller_id": caller,
            "callee_id": "212600000002", "duration_sec": duration, "cell_id": "C_01", "technology": "4G"}
