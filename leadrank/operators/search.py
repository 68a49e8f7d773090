"""Free-text search by an inverted index of trigrams.

The index has a row for each three letters in a row that a text of an id holds, by bucket and in the order of letters, so
that a search reads the buckets and row groups of its own trigrams only. Ids that hold all trigrams of the query are
candidates; whoever searches compares their texts. A query of fewer than three letters has no trigrams: it scans.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

BUCKETS = 64
GRAM = 3


def trigrams(text: Column) -> Column:
    """Different runs of three code points of the lower-case text; null and shorter texts have none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    places = F.when(F.char_length(low) >= GRAM, F.sequence(F.lit(1), F.char_length(low) - (GRAM - 1)))
    return F.coalesce(F.array_distinct(F.transform(places, lambda i: F.substr(low, i, F.lit(GRAM)))), F.array().cast("array<string>"))


class TrigramIndex:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def postings(self, query: str) -> DataFrame | None:
        """(bucket, gram, key) of the query's trigrams, or None if it has none."""
        low = query.lower()
        grams = sorted({low[i:i + GRAM] for i in range(len(low) - GRAM + 1)})
        if not grams:
            return None
        asked = self.spark.createDataFrame([(g,) for g in grams], "gram string")
        buckets = [r.bucket for r in asked.select(_bucket(F.col("gram")).alias("bucket")).distinct().collect()]
        rows = self.spark.read.parquet(self.path)
        return rows.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))

    def candidates(self, query: str) -> DataFrame | None:
        """Keys with all trigrams of the query; None if it has none, and so every key is a candidate."""
        found = self.postings(query)
        if found is None:
            return None
        low = query.lower()
        many = len({low[i:i + GRAM] for i in range(len(low) - GRAM + 1)})
        return found.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == many).select(self.key)


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_index(rows: DataFrame, key: str, texts: list[Column]) -> TrigramIndex:
    """Index the texts of `rows`; a key may have any number of rows, and counts once for each trigram.

    Rows are dealt by ranges of trigram and key, so a trigram that most texts hold spreads over many tasks.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "trigrams")
    grams = rows.select(key, F.explode(F.array_distinct(F.flatten(F.array(*[trigrams(t) for t in texts])))).alias("gram")).distinct()
    placed = grams.withColumn("bucket", _bucket(F.col("gram")))
    (placed.repartitionByRange(F.col("bucket"), F.col("gram"), F.col(key)).sortWithinPartitions("bucket", "gram")
     .write.partitionBy("bucket").parquet(path))
    if placed.isEmpty():  # nothing was written that a reader could learn the columns from
        placed.write.mode("overwrite").parquet(path)
    return TrigramIndex(spark, path, key)
