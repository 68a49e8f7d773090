"""Documents packed into sequences of fixed length by best-fit decreasing, certified by lower bounds.

Each partition packs its pieces by best-fit decreasing, works on piece lengths only, and compares its bin count with
lower bounds from dual feasible functions. A partition that meets its bound is done. One with a gap keeps its fullest
bins and puts the pieces of its emptiest ones into a pool. Partitions exchange pieces through the pool: it is dealt
out over fewer partitions, which pack it again, until one partition is left. A partition gives away a bounded number
of bins, so no partition of any round grows with the table.
"""
from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table
from .common import slices
from .tokens import TEXTS_AT_ONCE, VOCABULARY, encode

CAPACITY = 2048
#: Pieces that one partition packs in the first round.
PIECES_AT_ONCE = 50_000
#: Bins that a partition with a gap gives to the pool at most, and partitions whose pools meet in one.
POOLED_BINS = 256
FAN_IN = 16


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all of full length but perhaps the first."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, doc_id, piece, start, length, ids) as a stage table; ids are little-endian unsigned 32-bit integers."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            rows, data = [], []
            for row, ids in enumerate(encode(batch.column(1), vocabulary)):
                for number, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append((row, number, start, length))
                    data.append(ids[start:start + length].tobytes())
            if rows:
                row, number, start, length = (pa.array(x, pa.int64()) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), number.cast(pa.int32()), start, length,
                                                  pa.array(data, pa.binary())],
                                                 ["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    cut = docs.select(doc_id, text).mapInArrow(work, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")
    # the key is drawn once, in the job that writes the table
    return stage_table(cut.withColumn("key", F.monotonically_increasing_id()), "pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: members of each bin. Equal lengths go by their order."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[place].append(item)
        else:
            room, place = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(place)
        rooms |= 1 << (room - size)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound on the bin count of two families of dual feasible functions (sizes and results times capacity).

    The first, for each threshold t up to half: sizes over capacity - t count as full, sizes under t as nothing. The
    second, for k = 1..20: sizes are rounded down to multiples of 1/k after scaling by k + 1, unless they are even.
    """
    if not len(lengths):
        return 0
    many = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    mass, count = np.cumsum(many * size), np.cumsum(many)
    t = np.arange(0, capacity // 2 + 1)
    under = np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    best = int((mass[capacity - t] - under + capacity * (count[-1] - count[capacity - t])).max())
    bound = -(-best // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * size
        even = scaled % capacity == 0
        total = int((many * np.where(even, size * k, scaled // capacity * capacity)).sum())
        bound = max(bound, -(-total // (capacity * k)))
    return bound


def pack_partition(rows: pd.DataFrame, *, capacity: int, last: bool) -> pd.DataFrame:
    """Bin and offset of each piece of one partition; `open` marks pieces that go to the pool."""
    rows = rows.sort_values(["length", "key"], ascending=[False, True], ignore_index=True)
    lengths = rows.length.to_numpy()
    bins = best_fit(lengths, capacity)
    bin_of, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    room = np.empty(len(bins), np.int64)
    for number, members in enumerate(bins):
        at = 0
        for item in members:
            bin_of[item], offset[item] = number, at
            at += int(lengths[item])
        room[number] = capacity - at
    pooled = np.zeros(len(bins), bool)
    if not last and len(bins) > lower_bound(lengths, capacity):
        emptiest = np.argsort(-room, kind="stable")[:POOLED_BINS]
        pooled[emptiest[room[emptiest] > 0]] = True
    return pd.DataFrame({"key": rows.key, "part": rows.part, "bin": bin_of, "offset": offset, "open": pooled[bin_of]})


def _packer(capacity: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack_one(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_partition(rows, capacity=capacity, last=last)

    return pack_one


def plan(lengths: DataFrame, capacity: int = CAPACITY, pieces_at_once: int = PIECES_AT_ONCE) -> DataFrame:
    """(key, sequence_id, offset) for (key, length) with lengths from 1 to `capacity`. `lengths` must be stored."""
    full = lengths.filter(F.col("length") == capacity)
    closed = [full.select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    pool = lengths.filter(F.col("length") < capacity)
    parts, turn = max(1, math.ceil(pool.count() / pieces_at_once)), 1
    while True:
        last = parts == 1
        dealt = pool.select("key", "length", F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(parts)).alias("part"))
        packed = stage_table(dealt.groupBy("part").applyInPandas(
            _packer(capacity, last),
            "key bigint, part bigint, bin bigint, offset bigint, open boolean"), f"packed-{turn}")
        # ids of different rounds and partitions differ; full pieces have the ids from 0 on
        number = -(F.lit(turn) * F.lit(1 << 56) + F.col("part") * F.lit(1 << 32) + F.col("bin"))
        closed.append(packed.filter(~F.col("open")).select("key", number.alias("sequence_id"), "offset"))
        if last:
            break
        pool = lengths.join(packed.filter("open").select("key"), "key", "left_semi")
        parts, turn = math.ceil(parts / FAN_IN), turn + 1
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    A document's ids end with id 0, so an empty or null text is one piece of length 1. Only documents longer than
    `capacity` are cut, into pieces of that length; the first may be shorter. Repeated rows and rows with a null
    doc_id are packed like any other. Other columns are not read. An empty table gives no rows.
    """
    cut = pieces(docs, doc_id, text, capacity, vocabulary)
    return cut.join(plan(cut.select("key", "length"), capacity), "key").drop("key")
