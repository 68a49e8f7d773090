"""Bytes covered by a repeated string of `length` bytes, by sorting sampled suffixes and inducing the rest.

As in external induced sorting, a sample of suffixes is sorted first and the order of all others follows from it.

1. Sample. Every string of `length` bytes has one anchor: of the `gram`-byte strings within it, the one with the
   smallest hash. Equal strings have their anchors at the same place, so about one suffix in 85 is enough.
2. Sorted sample. Anchors whose gram occurs once are dropped. The others are shuffled by the hash of the gram, with the
   bytes around them, and sorted by the text that follows. Spark's external sorter is the disk-backed priority queue:
   runs are spilled and merged, so a shard may be far larger than memory. Suffix tuples leave it in order, and
   neighbours give the lengths of their common prefixes.
3. Induction. Step d moves all suffixes one byte to the left. Suffixes with equal bytes on their left stay together, in
   the order they had, and their common prefixes are one longer. A string that starts d bytes before an anchor is
   repeated if another suffix of its class has a common prefix of `length` or more.

Nothing depends on a hash being free of collisions: bytes are compared.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table
from .common import map_batches, slices, utf8

LENGTH = 200
GRAM = 32
#: Suffixes that a task holds at once; a class of equal grams stays together, its exact copies count once.
SUFFIXES_AT_ONCE = 40_000
#: Bits of the filter of repeated grams, a constant that bounds what is broadcast (8 MB).
FILTER_BITS = 26
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash) of each anchor: it is the anchor of the strings that start at first..last."""
    if len(text) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    code, step = _TABLE[np.frombuffer(text, np.uint8)], 1
    while step < gram:  # hash of 2, 4, ... bytes; `gram` is a power of two
        code = code[:-step] * np.uint64(pow(int(_ODD), step, 1 << 64)) + code[step:]
        step *= 2
    code ^= code >> np.uint64(31)
    code *= _ODD
    code ^= code >> np.uint64(29)
    least = (code & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=np.uint64)  # ties go to the left
    wide, many = 1, length - gram + 1
    while 2 * wide <= many:
        least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
    if wide < many:
        least = np.minimum(least[:wide - many], least[many - wide:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.append(0, np.flatnonzero(np.diff(place)) + 1)
    last = np.append(first[1:], len(place)) - 1
    place = place[first]
    return place, first, last, code[place]


def _repeated_grams(rows: DataFrame, text: str, length: int, gram: int) -> np.ndarray:
    """Filter of the hashes that more than one anchor has: one bit per hash modulo its size."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [anchors(t, length, gram)[3] for t in utf8(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["h"])

    bit = F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (map_batches(rows.select(text), work, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _suffixes(rows: DataFrame, key: list[str], text: str, seen: np.ndarray, length: int, gram: int) -> DataFrame:
    """(h, following, before, key..., place) of anchors that may be repeated: one row per context and batch.

    before holds the bytes from the first string's start up to the anchor, in reverse; following those from the anchor
    to the last string's end. Equal contexts of a batch are one row with several places.
    """
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(seen))
    mask = np.uint64((1 << FILTER_BITS) - 1)
    at_type = f"array<struct<{', '.join(f'{k}: bigint' for k in key)}, place: bigint>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = np.unpackbits(shared.value).view(bool)
        for batch in slices(batches):
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(key)))))
            found: dict[tuple[int, bytes, bytes], list] = {}
            for row, t in zip(keys, utf8(batch.column(len(key)))):
                place, first, last, h = anchors(t, length, gram)
                for i in np.flatnonzero(maybe[(h & mask).astype(np.int64)]).tolist():
                    p = int(place[i])
                    context = int(h[i]), t[p:int(last[i]) + length], t[int(first[i]):p][::-1]
                    found.setdefault(context, []).append((*row, p))
            if found:
                h, following, before = zip(*found)
                names = [*key, "place"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(following, pa.binary()), pa.array(before, pa.binary()),
                     pa.array([[dict(zip(names, x)) for x in places] for places in found.values()],
                              pa.list_(pa.struct([(n, pa.int64()) for n in names])))],
                    ["h", "following", "before", "at"])

    return rows.select(*key, text).mapInArrow(work, f"h bigint, following binary, before binary, at {at_type}")


def _padded(texts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)


def induce(h: np.ndarray, following: list[bytes], before: list[bytes], length: int) -> np.ndarray:
    """Matrix (suffix, d): is the string that starts d bytes before the anchor repeated? Input in suffix order."""
    n, steps = len(following), max(map(len, before)) + 1
    ahead = np.array([len(t) for t in following])
    left = np.array([len(t) for t in before])
    text = _padded(following, length)
    differ = text[1:] != text[:-1]
    common = np.where(differ.any(1), differ.argmax(1), length)
    common = np.minimum(common, np.minimum(ahead[1:], ahead[:-1]))
    common[h[1:] != h[:-1]] = 0
    common = np.append(0, common)  # with the suffix before
    bytes_left = _padded(before, steps)
    repeated = np.zeros((n, steps), bool)
    loosest = np.cumsum(common < length - steps + 1)
    alive, kind = np.arange(n), np.zeros(n, np.int64)
    for d in range(steps):
        if d:  # one byte to the left: classes split by it and keep their order
            alive = alive[left[alive] >= d]
            if not len(alive):
                break
            wider = kind[alive] * 256 + bytes_left[alive, d - 1]
            kind[alive] = np.unique(wider, return_inverse=True)[1]
        run = np.cumsum(common < length - d)  # suffixes whose common prefix, d bytes longer now, is long enough
        full = alive[ahead[alive] >= length - d]
        label = run[full] * (n + 1) + kind[full]
        order = np.argsort(label, kind="stable")
        same = label[order][1:] == label[order][:-1]
        repeated[full[order[1:][same]], d] = True
        repeated[full[order[:-1][same]], d] = True
        if d < steps - 1:  # a suffix alone in its class stays alone, whatever its prefix
            loose = loosest[alive] * (n + 1) + kind[alive]
            _, back, many = np.unique(loose, return_inverse=True, return_counts=True)
            alive = alive[many[back] > 1]
    return repeated


def repeats(rows: DataFrame, key: list[str], text: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key..., start, end): byte ranges that are covered by repeated strings; they may overlap. `rows` is read twice."""
    sent = _suffixes(rows, key, text, _repeated_grams(rows, text, length, gram), length, gram)
    names = [*key, "start", "end"]

    def whole(following: bytes, before: bytes, at: list) -> Iterator[tuple]:
        for place in at:
            yield (*(place[k] for k in key), place["place"] - len(before), place["place"] + len(following))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []  # different contexts: hash, following, before, places that await a verdict
        out: list[tuple] = []

        def batch_out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names)

        def settle() -> None:
            found = induce(np.array([x[0] for x in held]), [x[1] for x in held], [x[2] for x in held], length)
            for (_, following, before, at), row in zip(held, found):
                if at and row.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
                    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):  # d from lo to hi - 1
                        out.extend((*(x[k] for k in key), x["place"] - hi + 1, x["place"] - lo + length) for x in at)
            held.clear()

        for batch in batches:
            for h, following, before, at in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:3] == [h, following, before]:  # a copy: all of its strings are repeated
                    out.extend(whole(following, before, [*held[-1][3], *at]))
                    held[-1][3] = []
                    continue
                if len(held) >= SUFFIXES_AT_ONCE and held[-1][0] != h:
                    settle()
                if len(at) > 1:
                    out.extend(whole(following, before, at))
                    at = []
                held.append([h, following, before, at])
            if out:
                yield batch_out()
                out.clear()
        if held:
            settle()
        if out:
            yield batch_out()

    return (sent.repartition("h").sortWithinPartitions("h", "following", "before")
            .mapInArrow(work, ", ".join(f"{c} bigint" for c in names)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: list[str] | None = None,
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row; kept is the binary text without repeated strings.

    `key` names long columns that tell rows apart, the same each time the table is read. Without it the table is
    stored with numbered rows first. A null text is an empty one; texts under `length` bytes stay whole; repeated rows
    lose all that is longer; kept may be cut within a character. An empty table gives no rows.
    """
    if key is None:
        docs, key = stage_table(docs.select(doc_id, text, F.monotonically_increasing_id().alias("_row")), "rows"), ["_row"]
    rows = docs.select(*key, text)
    spans = (repeats(rows, key, text, length, gram).groupBy(*key)
             .agg(F.collect_list(F.struct("start", "end")).alias("_spans")))  # of one text, bounded by it
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, found in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
            kept, at, removed, runs = [], 0, 0, 0
            for start, end in sorted((s["start"], s["end"]) for s in found or ()):
                if start > at or not runs:
                    kept.append(t[at:start])
                    runs += 1
                    at = start
                removed += max(0, end - at)
                at = max(at, end)
            out.append((len(t), removed, runs, b"".join([*kept, t[at:]])))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in list(zip(*out))[:3]),
                                           pa.array([x[3] for x in out], pa.binary())],
                                          ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return map_batches(docs.select(*key, doc_id, text).join(spans, key, "left").select(doc_id, text, "_spans"), work,
                       f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
