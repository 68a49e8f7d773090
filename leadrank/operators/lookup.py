"""Lookups in tables of ranges and of prefixes, of any size, as equi-joins.

A range of whole numbers is the sum of at most two aligned blocks of each power of two; a number lies in one block of
each size. So a number meets a range at exactly one block, and blocks are equal or not. A prefix of a code is one of
its beginnings with a length that the table uses. Different numbers and codes are looked up once, and what is found
joins back by value. Tables of a few dozen rows are better off as expressions (`functions/codes.py`).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage_table

_LEVELS = 62
_SHIFT = 40  # positions are below 2^40


def blocks_of(lo: Column, hi: Column) -> Column:
    """Aligned blocks (level, block) that add up to the whole numbers lo .. hi; none if lo > hi or one is null."""
    def at(level: Column) -> Column:
        first, end = -F.call_function("shiftright", -lo, level), F.call_function("shiftright", hi + 1, level)
        odd = lambda c: c.bitwiseAND(F.lit(1).cast("long")) == 1
        one = lambda cond, block: F.when(cond & (first < end), F.struct(level.alias("level"), block.alias("block")))
        return F.array_compact(F.array(one(odd(first), first), one(odd(end), end - 1)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS)), at))


def range_join(df: DataFrame, number: str, ranges: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the given columns of the first range that holds `number`; null if none does.

    `ranges` has lo, hi (both included) and position (unique, from 0), which says which of several ranges is first. Numbers
    and bounds are longs well below 2^62.
    """
    table = stage_table(ranges.select("position", F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"),
                                      *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]), "ranges")
    blocks = stage_table(table.select("position", F.explode(blocks_of(F.col("lo"), F.col("hi"))).alias("b"))
                         .select("position", "b.level", "b.block"), "range-blocks")
    levels = sorted(r.level for r in blocks.select("level").distinct().collect())  # at most one for each power of two
    asked = df.select(F.col(number).cast("long").alias("_number")).filter(F.col("_number").isNotNull()).distinct()
    probes = asked.select("_number", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")).alias("level")).select(
        "_number", "level", F.call_function("shiftright", F.col("_number"), F.col("level")).alias("block"))
    first = probes.join(blocks, ["level", "block"]).groupBy("_number").agg(F.min("position").alias("position"))
    return _join_back(df, F.col(number).cast("long"), first, table, columns)


def prefix_join(df: DataFrame, code: str, prefixes: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the given columns of the longest prefix that `code` begins with; null if none does.

    `prefixes` has prefix and position (unique, from 0); of equal prefixes the one with the smallest position counts. A
    null prefix fits nothing, an empty one every code.
    """
    table = stage_table(prefixes.filter(F.col("prefix").isNotNull()).select(
        "position", "prefix", *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]), "prefixes")
    long = F.char_length("prefix")
    lengths = sorted(r.n for r in table.select(long.alias("n")).distinct().collect())  # one row a length
    asked = df.select(F.col(code).alias("_code")).filter(F.col("_code").isNotNull()).distinct()
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("_code"))
    probes = asked.select("_code", F.explode(F.transform(fitting, lambda n: F.substr("_code", F.lit(1), n))).alias("prefix"))
    # the longest prefix, of equal ones the first: one whole number to take the largest of
    worth = long.cast("long") * (1 << _SHIFT) + ((1 << _SHIFT) - 1 - F.col("position"))
    best = probes.join(table.select("prefix", "position"), "prefix").groupBy("_code").agg(F.max(worth).alias("worth"))
    first = best.select(F.col("_code").alias("_number"), ((1 << _SHIFT) - 1 - F.col("worth").bitwiseAND(F.lit((1 << _SHIFT) - 1))).alias("position"))
    return _join_back(df, F.col(code), first, table, columns)


def _join_back(df: DataFrame, value: Column, first: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    found = first.join(table, "position").select("_number", *[F.col(f"_{i}") for i in range(len(columns))])
    return (df.withColumn("_value", value).join(found, F.col("_value") == F.col("_number"), "left")
            .select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_{i}").alias(c) for i, c in enumerate(columns)]))
