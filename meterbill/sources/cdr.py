"""Usage-record sources: message streams and JSON decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.schemas import RAW_CDR


def read_cdr_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                    **options: str) -> DataFrame:
    """Unbounded frame with a ``value`` column holding one JSON message.

    ``source="kafka"`` subscribes to a topic (pass ``kafka.bootstrap.servers``
    and ``subscribe``; defaults start at latest and tolerate data loss).
    ``source="text"`` reads newline-delimited JSON files from ``path``; it has
    the same ``value STRING`` contract and is what tests use.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        options = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
    for k, v in options.items():
        reader = reader.option(k.replace("__", "."), v)
    return reader.load(path) if path else reader.load()


def decode_cdr(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """value -> the 12 raw fields (permissive: malformed fields become NULL).

    ``keep`` passes extra source columns through (e.g. a Kafka offset).
    """
    parsed = F.from_json(F.col("value").cast("string"), RAW_CDR).alias("data")
    return df.select(*keep, parsed).select(*keep, "data.*")
