"""Spelling variants: words one edit apart, found by probing generated edits against broadcast Bloom filters.

The filter of the vocabulary is sharded by word length; a block is one 64-bit word with four bits for each word it
holds. Every word makes its edits as hashes: each of its letters replaced by each later letter of the alphabet that the
vocabulary uses, and each letter deleted. That meets each pair of near words exactly once: an inserted letter is a
deleted one seen from the other word. A deletion is probed in the shard of the next shorter words. The hash is a
polynomial in the letters, so that an edit changes it by one term. Only edits that the filter holds become text and go
to an exact join with the vocabulary, which removes false positives.

What is broadcast at once is bounded: shards are taken in passes of at most `MAX_BLOCKS` blocks, and a shard larger than
that is split by hash. So the number of passes grows with the vocabulary, and the false positives' share does not.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table
from .common import slices, utf8

LETTER = "[a-z\u00c0-\u00ff]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is so many times as frequent as the word, at least.
RATIO = 10
BITS_PER_WORD = 24
#: Blocks of 64 bits that one pass broadcasts at most (16 MB).
MAX_BLOCKS = 1 << 21
#: Edits that a task holds at once.
EDITS_AT_ONCE = 1 << 18
#: Texts that are counted before their words are passed on.
TEXTS_AT_ONCE = 4000
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_MIX = 0x9E3779B97F4A7C15


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Callable[[object, str], str] | None = None,
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts with their numbers of occurrences, as a stage table.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case, of at least `least_length` code points
    and met at least `least_count` times. `change(id, run)` may replace such a run; its result is counted if it is as
    long. Null and empty texts have no words; a row counts as often as it is repeated.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            total: Counter = Counter()
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                runs = Counter(longer.findall(t.lower().decode()))  # on bytes: only A-Z
                if change is not None:
                    for run, n in runs.items():
                        total[change(i, run)] += n
                else:
                    total.update(runs)
            words = [w for w in total if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())],
                                             ["word", "n"])

    longer = re.compile(f"{LETTER}{{{least_length},}}")
    found = docs.select(doc_id, text).mapInArrow(work, "word string, n bigint")
    return stage_table(found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count), "vocabulary")


def _mixed(h: np.ndarray) -> np.ndarray:
    z = (h ^ (h >> 32)) * np.uint64(_MIX)
    return z ^ (z >> 29)


def _values(codes: np.ndarray) -> np.ndarray:
    """A number for each letter, so that sums of terms look random."""
    return _mixed((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(length, _BASE, np.uint64)))


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in `words`, letters as code points in a table of that width)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        joined = "".join([words[i] for i in at]).encode("utf-32-le")
        yield length, at, np.frombuffer(joined, np.uint32).reshape(len(at), length)


def _places(z: np.ndarray, blocks: int) -> np.ndarray:
    return ((z >> 32) * np.uint64(blocks) >> 32).astype(np.int64)


def _part(z: np.ndarray, parts: int) -> np.ndarray:
    return (z >> 24 & 255).astype(np.int64) % parts


def _bit(z: np.ndarray, number: int) -> np.ndarray:
    return np.uint64(1) << (z >> 6 * number & 63)


class Shard:
    """The part of the filter that holds the words of one length, or of one of `parts` shares of them by hash."""

    def __init__(self, blocks: int, part: int, parts: int):
        self.bits, self.part, self.parts = np.zeros(blocks, np.uint64), part, parts

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be words."""
        z = _mixed(h)
        at = np.flatnonzero(self.bits[_places(z, len(self.bits))] & _bit(z, 0))
        z = z[at]
        block = self.bits[_places(z, len(self.bits))]
        mask = _bit(z, 1) | _bit(z, 2) | _bit(z, 3)
        held = (block & mask) == mask
        if self.parts > 1:
            held &= _part(z, self.parts) == self.part
        return at[held]


def edits(codes: np.ndarray, letters: np.ndarray, shards: dict[int, Shard]) -> Iterator[tuple[int, int, int]]:
    """(row, place, letter): edits of the words in `codes` that a shard may hold. The letter -1 stands for a deletion."""
    rows, length = codes.shape
    values, power = _values(codes), _powers(length)
    terms = values * power[:length]
    whole = terms.sum(1, dtype=np.uint64)
    if length in shards:
        held, own = shards[length], _values(letters)
        step = max(1, EDITS_AT_ONCE // max(1, len(letters)))
        for a in range(0, rows, step):
            for k in range(length):
                h = (whole[a:a + step] - terms[a:a + step, k])[:, None] + (own * power[k])[None, :]
                later = codes[a:a + step, k][:, None] < letters[None, :]
                wanted = np.flatnonzero(later.ravel())
                hits = wanted[held.holds(h.ravel()[wanted])]
                for i, letter in zip(*divmod(hits, len(letters))):
                    yield a + int(i), k, int(letters[letter])
    if length - 1 in shards:
        held, before = shards[length - 1], np.zeros(rows, np.uint64)
        for k in range(length):
            after = whole - before - terms[:, k]
            # of a run of equal letters only the first is deleted
            new = np.flatnonzero(codes[:, k] != codes[:, k - 1]) if k else np.arange(rows)
            for i in new[held.holds((before + after * np.uint64(_BACK))[new])]:
                yield int(i), k, -1
            before = before + terms[:, k]


def _filter_rows(words: DataFrame, blocks: dict[int, int], parts: dict[int, int]) -> DataFrame:
    """(length, part, block, bits): all shards' blocks that hold a word, as a stage table."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 15):
            for length, at, codes in _by_length(batch.column(0).to_pylist()):
                z = _mixed((_values(codes) * _powers(length)[:length]).sum(1, dtype=np.uint64))
                bits = _bit(z, 0) | _bit(z, 1) | _bit(z, 2) | _bit(z, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), length, np.int32)), pa.array(_part(z, parts[length]).astype(np.int32)),
                     pa.array(_places(z, blocks[length])), pa.array(bits.view(np.int64))], ["length", "part", "block", "bits"])

    rows = words.select("word").mapInArrow(work, "length int, part int, block bigint, bits bigint")
    return stage_table(rows.groupBy("length", "part", "block").agg(F.bit_or("bits").alias("bits")), "spelling-filter")


def _passes(shards: list[tuple[int, int, int, int]]) -> Iterator[list[tuple[int, int, int, int]]]:
    """Shards (length, part, parts, blocks) in groups of at most MAX_BLOCKS blocks."""
    held, size = [], 0
    for shard in shards:
        if held and size + shard[3] > MAX_BLOCKS:
            yield held
            held, size = [], 0
        held.append(shard)
        size += shard[3]
    if held:
        yield held


def _probed(words: DataFrame, letters: np.ndarray, group: list[tuple[int, int, int, int]], rows: DataFrame) -> DataFrame:
    """(variant, word, n): edits of all words that one pass's shards may hold, as a stage table."""
    shards = {length: Shard(blocks, part, parts) for length, part, parts, blocks in group}
    wanted = F.struct("length", "part").isin([F.struct(F.lit(g[0]), F.lit(g[1])) for g in group])
    found = rows.filter(wanted).select("length", "block", "bits").toArrow()  # at most MAX_BLOCKS rows
    length, block, bits = (found.column(i).to_numpy() for i in range(3))
    for key, shard in shards.items():
        mine = length == key
        shard.bits[block[mine]] = bits[mine].view(np.uint64)
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast((letters, shards))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, shards = shared.value
        for batch in slices(batches, 1 << 13):
            texts, n = batch.column(0).to_pylist(), batch.column(1)
            held: tuple[list, list] = ([], [])
            for length, at, codes in _by_length(texts):
                if length in shards or length - 1 in shards:
                    for i, k, letter in edits(codes, letters, shards):
                        word = texts[at[i]]
                        held[0].append(word[:k] + ("" if letter < 0 else chr(letter)) + word[k + 1:])
                        held[1].append(at[i])
            if held[0]:
                row = pa.array(held[1], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.string()), batch.column(0).take(row), n.take(row)],
                                                 ["variant", "word", "n"])

    lengths = sorted({g[0] + d for g in group for d in (0, 1)})
    some = words.filter(F.char_length("word").isin(lengths)).select("word", "n").repartition(F.xxhash64("word"))
    out = stage_table(some.mapInArrow(work, "variant string, word string, n bigint"), "spelling-edits")
    shared.destroy()
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, m): every unordered pair of near words once. `words` is a stage table of different words with counts."""
    sizes = words.groupBy(F.char_length("word").alias("length")).count().collect()  # one row a length
    none = words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("m")).limit(0)
    if not sizes:
        return none

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(set().union(*batch.column(0).to_pylist())), pa.string())], ["letter"])

    alphabet = words.select("word").mapInArrow(used, "letter string").distinct().toArrow()  # one row a letter
    letters = np.sort(np.array([ord(c) for c in alphabet.column(0).to_pylist()], np.uint32))
    need = {r.length: -(-r["count"] * BITS_PER_WORD // 64) for r in sizes}
    parts = {length: min(256, -(-n // MAX_BLOCKS)) for length, n in need.items()}
    blocks = {length: max(1, -(-n // parts[length])) for length, n in need.items()}
    rows = _filter_rows(words, blocks, parts)
    shards = [(length, part, parts[length], blocks[length]) for length in sorted(need) for part in range(parts[length])]
    variants = None
    for group in _passes(shards):
        found = _probed(words, letters, group, rows)
        variants = found if variants is None else variants.unionAll(found)
    known = words.select(F.col("word").alias("variant"), F.col("n").alias("m"))
    return variants.join(known, "variant").select("word", "n", F.col("variant").alias("other"), "m")


def _last(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, in rounds that double what is followed.

    A form is `RATIO` times as frequent as its word, so a chain is no longer than the digits of a count.
    """
    reach = stage_table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage_table(reach.join(onward, "root", "left"), "spelling-roots")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return reach
        reach = moved.select("word", F.coalesce("next", "root").alias("root"))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of `words` (word, n; a stage table without repeats).

    A word's form is its near word of largest n, of equally frequent ones the first in code-point order, if that is
    `ratio` times as frequent at least. root follows forms to the last; it is the word itself if it has none.
    """
    one = near_pairs(words)
    both = one.unionAll(one.select("other", "m", "word", "n"))
    near = (both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")))
    fits = -F.col("best.m") >= ratio * F.col("n")
    judged = stage_table(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "spelling-forms")
    roots = _last(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
