"""Quality rules by host: rule failures are added up by host, shrunk towards all hosts, and judged.

The base rules look at one text. Their failures are counted per host. How much host rates differ beyond chance gives
the strength of a beta prior (by the method of moments), and every host's rate is shrunk towards the common one by it,
so a host with few documents is judged little by them. Verdicts on hosts are joined back to documents.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table
from .common import join_unique, map_batches, utf8

LEAST_WORDS = 50
REPEATED_PERCENT = 50
#: A host is rejected if its shrunk failure rate is higher.
HOST_LIMIT = 0.5
#: Bounds of the strength of the prior, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\v\f\r"


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.split()
    continued = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    characters = len(text) - continued - sum(text.count(b) for b in (_BLANKS[i:i + 1] for i in range(len(_BLANKS))))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = 0
    if often:
        within = np.zeros(len(words) + 1, np.int64)
        at = np.fromiter((i for i, w in enumerate(windows) if w in often), np.int64)
        np.add.at(within, at, 1)
        np.add.at(within, at + 3, -1)
        repeated = int(np.count_nonzero(np.cumsum(within)))
    return (len(words), characters, sum(text.count(SYMBOLS[i:i + 1]) for i in range(len(SYMBOLS))),
            len(lines) - len(set(lines)), repeated)


def base_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the five measures and base_failed of every row; a null text is an empty one."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([measures(t) for t in utf8(batch.column(2))], np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, found.T.copy())],
                                          ["doc_id", "host", *names])

    kinds = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, host string"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return (map_batches(docs.select(doc_id, F.col(host).cast("string"), text), work, f"{kinds}, {', '.join(f'{n} bigint' for n in names)}")
            .withColumn("base_failed", failed))


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n, failed, rate, host_rejected) of every host that is not null; `rate` is the shrunk rate."""
    hosts = (measured.filter(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed")))
    hosts = stage_table(hosts, "hosts")
    own = F.col("failed") / F.col("n")
    x = hosts.agg((F.sum("failed") / F.sum("n")).alias("mean"), F.avg(own).alias("own"), F.avg(own * own).alias("square"),
                  F.avg(1 / F.col("n")).alias("inverse")).first()
    mean, strength = x.mean or 0.0, MOST_STRENGTH
    if x.mean is not None:
        beyond_chance = x.square - 2 * mean * x.own + mean ** 2 - mean * (1 - mean) * x.inverse
        if beyond_chance > 0:
            strength = min(MOST_STRENGTH, max(LEAST_STRENGTH, mean * (1 - mean) / beyond_chance - 1))
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", "n", "failed", rate.alias("rate"), (rate > limit).alias("host_rejected"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of every row, base_failed, and kept: neither the text nor its host is rejected.

    A null host is no host: such texts are judged by themselves. Repeated rows count and come out each. Other columns
    are not read. An empty table gives no rows.
    """
    measured = stage_table(base_measures(docs, doc_id, text, host), "measures")
    rejected = host_verdicts(measured, limit).filter("host_rejected").select("host", "host_rejected")
    return (join_unique(measured, rejected, "host", F.col("doc_id"))
            .withColumn("kept", ~F.col("base_failed") & F.col("host_rejected").isNull()).drop("host_rejected"))
