"""What several operators need: reading tables, batches of texts, joins that withstand hot keys."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A key is hot if it holds more than one row in HOT_SHARE. So there are at most HOT_SHARE hot keys, however
#: large the table is, which bounds what `join_unique` broadcasts.
HOT_SHARE = 1000
#: Parts that the rows of a hot key are dealt to.
SALTS = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task turns into Python objects at once.
ROWS_AT_ONCE = 1000


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most `rows` rows; empty ones are passed over."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply `work` to `df` slice by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(work, slices(batches))
    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def join_unique(big: DataFrame, unique: DataFrame, key: str, spread: Column, how: str = "left") -> DataFrame:
    """Join `big` to `unique`, which has one row per key, with no task that gets all rows of a hot key.

    Rows of a hot key are dealt to SALTS parts by a hash of `spread` (a column that tells rows apart), and the few
    rows of `unique` that hot keys meet are repeated once per part. `big` is read twice: pass a stage table.
    A null key meets nothing, as in any SQL join.
    """
    rows = big.count()
    hot = (big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HOT_SHARE > rows)
           .filter(F.col(key).isNotNull()).select(key, F.lit(True).alias("_hot")))
    salted = big.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_hot")
    copies = unique.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
