"""Marked spans of texts: arrays of (kind, start, end, base) in code points, end exclusive."""
from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches

Span = tuple[int, int, int, bool]  # start, number of the kind, end, whether a base rule found it
TYPE = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def mark(docs: DataFrame, find: Callable[[str], Iterable[Span]], kinds: list[str], doc_id: str, text: str) -> DataFrame:
    """(doc_id, spans) of every row; spans are ordered by start, then by the order of `kinds`."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[(kinds[kind], start, end, base) for start, kind, end, base in sorted(find(t or ""))]
               for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _ARROW)], ["doc_id", "spans"])

    return map_batches(docs.select(doc_id, text), work,
                       f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans {TYPE}")


class Taken:
    """Places that spans cover; asking takes logarithmic time."""

    def __init__(self, spans: Iterable[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end, _ in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start

    def add(self, start: int, end: int) -> None:
        """Take a place that overlaps none so far."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def redact(text: str, spans: Iterable[Span], mask: str) -> str:
    """`text` with each run of overlapping spans replaced by `mask`."""
    out, at = [], 0
    for start, _, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(marked: DataFrame, base_kinds: list[str]) -> DataFrame:
    """doc_id, the count of base spans of each kind, the hash of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base_kinds]
    return marked.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                         listed(F.col("spans")).alias("spans"))
