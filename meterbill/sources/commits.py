"""Appends that can be repeated.

A run writes below a folder of its own (``run=<id>``) and counts from the
moment its marker exists: one small file, made under another name and renamed.
A driver that dies before that leaves rows that no committed read sees; the
same run, started again, overwrites them. A run that is committed writes
nothing. Readers name the committed folders, so a plain reader's cost stays:
``run`` and the caller's partition columns prune as in any partitioned table.

Run ids are the caller's: what identifies the work (a window, a month, a batch
id), not the attempt. One run at a time may write a given id.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterbill.sources.tables import empty_frame

RUN = "run"
_MARKERS = "_committed"          # a leading underscore hides it from readers


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def check_run(run: str) -> str:
    """Run ids become folder names and partition values."""
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9._-]{0,120}", run):
        raise ValueError(f"a run id starts with a letter and has letters, digits, '.', '_' and '-': {run!r}")
    return run


def committed_runs(spark: SparkSession, path: str) -> list[str]:
    fs, at = _file_system(spark, path)
    if not fs.exists(at(f"{path}/{_MARKERS}")):
        return []
    names = (f.getPath().getName() for f in fs.listStatus(at(f"{path}/{_MARKERS}")))
    return sorted(n for n in names if not n.startswith("."))


def is_committed(spark: SparkSession, path: str, run: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at(f"{path}/{_MARKERS}/{check_run(run)}"))


def discard(spark: SparkSession, path: str, run: str) -> None:
    """Delete what an attempt that was never committed has left."""
    if is_committed(spark, path, run):
        raise ValueError(f"run {run!r} of {path} is committed")
    fs, at = _file_system(spark, path)
    fs.delete(at(f"{path}/{RUN}={run}"), True)


def commit(spark: SparkSession, path: str, run: str) -> None:
    """Make the run's rows count. Renaming is one step on a file system; the
    marker's name alone says that the run is committed."""
    fs, at = _file_system(spark, path)
    made = at(f"{path}/{_MARKERS}/.{check_run(run)}")
    fs.create(made, True).close()
    if not fs.rename(made, at(f"{path}/{_MARKERS}/{run}")) and not is_committed(spark, path, run):
        raise OSError(f"run {run!r} of {path} could not be committed")


def append_run(df: DataFrame, path: str, run: str, partition_by: Sequence[str] = ()) -> bool:
    """Append ``df`` as ``run``; False if that run is committed already."""
    spark = df.sparkSession
    if is_committed(spark, path, run):
        return False
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{RUN}={run}")
    commit(spark, path, run)
    return True


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed runs, with their ``run``. ``schema`` has the
    partition columns too."""
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    runs = committed_runs(spark, path)
    if not runs:
        return empty_frame(spark, whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{RUN}={r}" for r in runs])
