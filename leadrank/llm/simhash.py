"""Near-duplicate groups from SimHash fingerprints by meet-in-the-middle ball hashing.

Two fingerprints at most 2h bits apart have a common neighbour at most h bits from either. So every distinct
fingerprint emits all variants within h bits, and fingerprints meet at equal variants. A full ball has 2,081
variants (h = 2); shuffling each would cost 30 times the text. Variants are therefore dealt out by their first
`prefix_bits` bits: a fingerprint is sent once to each prefix that its variants have (79 for 12 bits), and the task
that owns a prefix makes the variants with that prefix itself, sorts them and verifies the pairs that collide. The
prefix length follows the number of fingerprints, so a prefix keeps a like number of variants at any size, and a
prefix with too many (a dense family of near copies) is worked off in parts by its next bits, in bounded memory.

Holders of one variant are linked in a chain, not in all pairs: the components are the same.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.components import connected_components
from ..session import stage_table
from .common import join_unique, map_batches, utf8

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Variants that a task makes and sorts at once.
VARIANTS_AT_ONCE = 2_000_000
HASHES_AT_ONCE = 1 << 16


def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text: a bit is set if more than half of the shingle hashes have it."""
    words = text.lower().split()  # on bytes: only A-Z, and only blank and 9-13
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    shingles = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, shingles, HASHES_AT_ONCE):
        stop = min(shingles, at + HASHES_AT_ONCE)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b - 1], SEED) for a, b in
                              zip(starts[at:stop], ends[min(width, len(words)) - 1 + at:])), np.uint64, stop - at)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > shingles).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
                 row: str | None = None) -> DataFrame:
    """(doc_id, fp) or, with a long column `row`, (doc_id, row, fp): fp holds the 64 bits as a signed long.

    Null and empty texts have fingerprint 0.
    """
    kept = [doc_id] if row is None else [doc_id, row]
    names = ["doc_id", "row"][:len(kept)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([simhash(t, width) for t in utf8(batch.column(len(names)))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(found)], [*names, "fp"])

    kinds = [f"{name} {docs.schema[c].dataType.simpleString()}" for name, c in zip(names, kept)]
    return map_batches(docs.select(*kept, text), work, ", ".join([*kinds, "fp bigint"]))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All numbers of `bits` bits with at most `flips` ones."""
    return np.array([sum(1 << b for b in c) for n in range(min(bits, flips) + 1)
                     for c in combinations(range(bits), n)], np.uint64)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each component of the graph with edges a-b on 0..n-1."""
    root = np.arange(n)
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return root


def _meet(fps: np.ndarray, prefix: int, bits: int, half: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints whose variants begin with the `bits` bits of `prefix`."""
    low = BITS - bits
    spent = np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(prefix))
    masks = {d: _masks(low, half - d) for d in range(half + 1)}
    if sum(len(masks[d]) * int((spent == d).sum()) for d in masks) > VARIANTS_AT_ONCE and low > 8:
        for more in range(16):
            longer = prefix << 4 | more
            part = fps[np.bitwise_count((fps >> np.uint64(low - 4)) ^ np.uint64(longer)) <= half]
            if len(part) > 1:
                yield from _meet(part, longer, bits + 4, half)
        return
    variants, owners = [], []
    for d, mask in masks.items():
        mine = np.flatnonzero(spent == d)
        tails = fps[mine] & np.uint64((1 << low) - 1)  # all variants here share the prefix
        variants.append((tails[:, None] ^ mask).ravel())
        owners.append(np.repeat(mine, len(mask)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    met = np.flatnonzero(variant[1:] == variant[:-1])
    a, b = owner[met], owner[met + 1]
    true = np.bitwise_count(fps[a] ^ fps[b]) <= 2 * half
    root = _forest(a[true], b[true], len(fps))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    yield fps[linked], fps[root[linked]]


def ball_links(distinct: DataFrame, radius: int = RADIUS, prefix_bits: int | None = None) -> DataFrame:
    """(src, dst): links whose components are those of all pairs at most `radius` bits apart.

    `distinct` has a column fp without repeats. `radius` must be even: the balls have half of it.
    """
    if radius % 2 or radius < 2:
        raise ValueError("the radius of ball hashing is an even number of bits")
    half = radius // 2
    if prefix_bits is None:
        prefix_bits = min(24, max(8, distinct.count().bit_length() - 6))
    bits = prefix_bits

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():  # the fingerprints of each prefix in turn; rows arrive sorted by prefix
            held_prefix, held = None, []
            for batch in batches:
                prefix, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                cuts = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(prefix)]):
                    if lo == hi:
                        continue
                    if prefix[lo] != held_prefix:
                        if held:
                            yield held_prefix, np.concatenate(held)
                        held_prefix, held = prefix[lo], []
                    held.append(fp[lo:hi])
            if held:
                yield held_prefix, np.concatenate(held)

        for prefix, fp in runs():
            for src, dst in _meet(fp.view(np.uint64), int(prefix), bits, half):
                if len(src):
                    yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))],
                                                     ["src", "dst"])

    own = F.shiftrightunsigned("fp", BITS - bits)
    flips = F.array(*[F.lit(int(m)).cast("long") for m in _masks(bits, half)])
    sent = distinct.select(F.explode(F.transform(flips, lambda m: own.bitwiseXOR(m))).alias("prefix"), "fp")
    return (sent.repartition("prefix").sortWithinPartitions("prefix")
            .mapInArrow(work, "src bigint, dst bigint").distinct())


def _rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """`distinct` (a column fp without repeats, and others) with the root of each fingerprint's component."""
    roots = connected_components(ball_links(distinct.select("fp"), radius))
    return stage_table(distinct.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left")
                       .withColumn("root", F.coalesce("root", "fp")), "simhash-roots")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    component_id is the smallest doc_id reachable over links. Repeated rows come out repeated. Texts without words
    have fingerprint zero and link like any other. A null doc_id stays null; it is never a component_id unless no
    document of the group has an id. Other columns of `docs` are not read. An empty table gives no rows.
    """
    marked = stage_table(fingerprints(docs, doc_id, text, width), "simhash")
    distinct = stage_table(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    rooted = _rooted(distinct, radius)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = join_unique(rooted, smallest, "root", F.col("fp")).select("fp", "component_id")
    return join_unique(marked, groups, "fp", F.col("doc_id")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def chosen(docs: DataFrame, row: str, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
           radius: int = RADIUS) -> DataFrame:
    """(doc_id, row): of each component the row with the smallest id, and of those the smallest `row` (a long column).

    Rows without an id come last, so one is chosen only where a component has no other.
    """
    marked = fingerprints(docs, doc_id, text, width, row)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("best")
    rooted = _rooted(stage_table(marked.groupBy("fp").agg(best), "simhash-distinct"), radius)
    return rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.row")
