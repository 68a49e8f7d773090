"""Token ids as ORC files in ascending order of document ids.

Files follow the order of ids and hold an ascending range each, so readers prune files and stripes by the minimum and
maximum of doc_id in the footers, row groups by the row index, and both by Bloom filters on doc_id; stripes are read
in parallel. Ids are integers in ORC's run-length encoding. A row also has the place of its ids within its file's
part, so that no second pass over the ids is needed for places in the whole: only the narrow columns are added up.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import slices
from .tokens import TEXTS_AT_ONCE, VOCABULARY, encode

STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
BLOOM_ERROR = 0.01


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> None:
    """Write doc_id, part, part_start, n_tokens, ids. Null ids come first, rows of one id go by a hash of the text;
    a null text is an empty one. An empty table gives files without rows."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in slices(batches, TEXTS_AT_ONCE):
            ids = encode(batch.column(1), vocabulary)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(at + bounds[:-1]),
                 pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                                     pa.array(np.concatenate(ids).astype(np.int32)))],
                ["doc_id", "part", "part_start", "n_tokens", "ids"])
            at += int(bounds[-1])

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text, F.xxhash64(text).alias("_tie"))
    (rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", text)
     .mapInArrow(work, f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, ids array<int>")
     .write.option("compression", "zstd").option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.row.index.stride", str(INDEX_ROWS)).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", str(BLOOM_ERROR)).orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; filters on doc_id reach the stripes."""
    rows = spark.read.orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row per file
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = totals.select("part", before.alias("_before"))
    return (rows.join(F.broadcast(places), "part")  # one row per file
            .select("doc_id", (F.col("_before") + F.col("part_start")).alias("start"), "n_tokens", "ids"))
