"""Pages of an ordered list by an order-statistics table: rows per range partition.

The list is range-partitioned and sorted once, and stored by partition. The number of rows of each partition, one
number a partition, tells which partitions hold a page, so a page at any offset reads those and nothing else.
"""
from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

PART, INDEX = "_part", "_index"


class OrderedTable:
    """A stored, ordered list. `starts` are the positions (from 0) at which its partitions begin, and its length."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], parts: list[int], starts: list[int]):
        self.spark, self.path, self.columns, self.parts, self.starts = spark, path, columns, parts, starts

    def __len__(self) -> int:
        return self.starts[-1]

    def holding(self, offset: int, size: int) -> list[int]:
        """Numbers (in `parts`) of the partitions that hold rows offset to offset + size."""
        first, end = max(0, offset), min(offset + size, len(self))
        if first >= end:
            return []
        return list(range(bisect_right(self.starts, first) - 1, bisect_right(self.starts, end - 1)))

    def page(self, offset: int, size: int, position: str | None = None) -> DataFrame:
        """Rows offset+1 .. offset+size in order; `position` names a column for their places, from 1."""
        held = self.holding(offset, size)
        rows = self.spark.read.parquet(self.path)
        start = F.lit(0).cast("long")
        for i in held:
            start = F.when(F.col(PART) == self.parts[i], F.lit(self.starts[i]).cast("long")).otherwise(start)
        place = F.col(INDEX) + start
        found = (rows.filter(F.col(PART).isin([self.parts[i] for i in held])).withColumn(INDEX, place)
                 .filter(F.col(INDEX).between(offset, offset + size - 1)).orderBy(INDEX))
        more = [(F.col(INDEX) + 1).alias(position)] if position else []
        return found.select(*[F.col(f"`{c}`") for c in self.columns], *more)


def ordered_table(df: DataFrame, order: list[Column]) -> OrderedTable:
    """Store `df` in the total order `order`."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ordered")
    spot = F.monotonically_increasing_id()
    (df.orderBy(*order).withColumn(INDEX, spot)
     .withColumns({PART: F.shiftright(INDEX, 33).cast("int"), INDEX: F.col(INDEX).bitwiseAND((1 << 33) - 1)})
     .write.partitionBy(PART).parquet(path))
    try:
        counts = sorted(tuple(r) for r in spark.read.parquet(path).groupBy(PART).count().collect())  # one row a partition
    except Exception as e:  # an empty list has no partition, and so no columns to read
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        df.withColumns({INDEX: F.lit(0).cast("long"), PART: F.lit(0)}).limit(0).write.mode("overwrite").parquet(path)
        counts = []
    return OrderedTable(spark, path, df.columns, [p for p, _ in counts], [0, *accumulate(n for _, n in counts)])
