"""Pages of a long list, by seeking instead of sorting again.

The list is sorted once into ranges (a folder each) in which every row has its
place; an index holds one row a range: its first position. A page reads the
index, then the folders of the range or two it lies in, whatever its number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE, PLACE = "_range", "_place"
RANGE_ROWS = 100_000
FEW_RANGES = 200          # more ranges than these, each a task and a folder, only if they hold RANGE_ROWS rows
_INDEX = T.StructType([T.StructField(RANGE, T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("rows", T.LongType())])


class Pages:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.columns = spark, path, schema.names
        self.schema = T.StructType([*schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(RANGE, T.IntegerType())])

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[Column], path: str, range_rows: int = RANGE_ROWS) -> Pages:
        """Sort ``df`` into ranges of about ``range_rows`` rows below ``path``, of a
        long list more: as many as ``FEW_RANGES`` ranges need, up to ``RANGE_ROWS``
        (the driver samples, plans and lists by range). The order should be total:
        rows equal in it share a range."""
        made = cls(df.sparkSession, path, df.schema)
        n = df.count()
        parts = max(1, -(-n // max(range_rows, min(RANGE_ROWS, -(-n // FEW_RANGES)))))
        dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        numbered = dealt.withColumns({PLACE: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1), RANGE: F.spark_partition_id()})
        numbered.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
        sizes = made._rows().groupBy(RANGE).agg(F.count("*").alias("rows"))          # a row a range
        before = F.coalesce(F.sum("rows").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sizes.select(RANGE, before.cast("long").alias("start"), "rows").coalesce(1).write.mode("overwrite").parquet(f"{path}/index")
        return made

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def index(self) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(f"{self.path}/index")

    def page(self, number: int, size: int = 5) -> DataFrame:
        """Rows of page ``number`` (from 1), in order; none beyond the last."""
        first = (number - 1) * size
        hit = self.index().where((F.col("start") < first + size) & (F.col("start") + F.col("rows") > first)).collect()
        rows = self._rows().where(F.col(RANGE).isin([r[RANGE] for r in hit]))
        place = F.lit(None).cast("long")
        for r in hit:                                              # one or two, more only if a page spans ranges
            place = F.when(F.col(RANGE) == r[RANGE], F.col(PLACE) + r["start"]).otherwise(place)
        return (rows.withColumn(PLACE, place).where((F.col(PLACE) >= first) & (F.col(PLACE) < first + size))
                .orderBy(PLACE).select(*self.columns))

    def count(self, size: int = 5) -> DataFrame:
        """``total_items, total_pages`` from the index."""
        total = self.index().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_items"))
        return total.withColumn("total_pages", F.ceil(F.col("total_items") / F.lit(size)).cast("bigint"))
