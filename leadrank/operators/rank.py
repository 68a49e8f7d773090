"""Ordering and numbering rows without pulling a table or a hot group into one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage_table


def lead_order() -> list[Column]:
    """Best lead first. The id makes the order total, so ranks never depend on the input order."""
    return [F.desc("total"), F.desc_nulls_last("evidence_date"), F.desc_nulls_last("employees"),
            F.asc_nulls_last("name"), F.asc("facility_id")]


def _range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows range-partitioned and sorted, each with its partition and place in it.

    The result is materialised: partition bounds are sampled, so a second run of
    the plan could cut the table elsewhere.
    """
    spot = F.monotonically_increasing_id()
    placed = stage_table(df.orderBy(*order).withColumn("_spot", spot), "placed")
    return placed.withColumns({
        "_part": F.shiftright("_spot", 33).cast("int"),
        "_index": F.col("_spot").bitwiseAND((1 << 33) - 1)}).drop("_spot")


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position of each row in the total order `order`.

    Rows before a partition are the summed sizes of earlier partitions. That
    table has one row per partition, which is what bounds the window and the
    broadcast below.
    """
    placed = _range_sorted(df, order)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + F.col("_index") + 1).cast("long"))
            .drop("_part", "_index", "_offset"))


def position_within(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """0-based position inside each group; a group may span any number of tasks.

    Range partitioning by (group, order) cuts a hot group into many partitions.
    The helper table has one row per (group, partition it touches).
    """
    placed = _range_sorted(df, [F.asc(g) for g in group] + order)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (placed.groupBy(*group, "_part")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_index").alias("_first"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    return (placed.join(pieces, [*group, "_part"])
            .withColumn(name, F.col("_before") + F.col("_index") - F.col("_first"))
            .drop("_part", "_index", "_first", "_before"))


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """First `n` rows: each task keeps its own best n, one small merge follows."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """Rows offset+1 .. offset+size of the ordered list."""
    return df.orderBy(*order).offset(offset).limit(size)
