"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so hour/weekday match the 'Z' inputs,
# AQE for runtime re-planning (partition coalescing, skew-join splitting,
# broadcast conversion from measured sizes), no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error messages costs extra JVM round trips
    # on every DataFrame API call while a plan is being built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # dedup state is large: commit only the changelog per micro-batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "meterbill",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    On a cluster leave ``master`` unset so spark-submit decides. The
    checkpoint folder is only set here when the cluster has not named one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and "stateStore" not in k:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session that runs in one process (``local``, as in tests) may go
    without: a folder under the system temp dir is used. Elsewhere a missing
    setting is an error, because executors do not see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "meterbill-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: the context takes its folder
    from ``spark.checkpoint.dir``; only when none is configured the shared
    root above is set."""
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: the server's spark.checkpoint.dir applies
        return
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root. Frames that
    read it are lazy, so it lives until the driver's process ends."""
    path = f"{checkpoint_root(spark)}/meterbill/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(drop_scratch, spark.sparkContext._gateway.jvm)
    _SCRATCH.append(path)
    return path


def drop_scratch(jvm) -> None:
    """Delete the folders that ``scratch_path`` gave out."""
    try:
        conf = jvm.org.apache.hadoop.conf.Configuration()
        for path in _SCRATCH:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        _SCRATCH.clear()
    except Exception as e:          # the JVM may be gone: say what stays
        print(f"scratch folders not deleted ({type(e).__name__}): {len(_SCRATCH)} below {_SCRATCH[0]}")
