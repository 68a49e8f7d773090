"""Documents that hold benchmark passages, also with small edits, by the q-gram lemma.

A passage of m characters that occurs with at most e edits shares at least m - q + 1 - q * e of its q-grams with the
place where it occurs, on diagonals (place in the document minus place in the passage) that span no more than e.
Diagonal bands of width 2 (e + 1) that overlap by half hold every such span. So a document is only compared with a
passage where one band has enough different q-grams of it, and there the edit distance is computed on that band.

Parts of a passage count as well: every run of SHORT + STEP - 1 normalised bytes of an item, 59 (some 13 words of 4.5 bytes
with their blank), holds a whole window of SHORT bytes, so a document with that run, as it stands, is always found. Shorter
runs may be; with edits a window is found within its own budget.

The benchmark is cut into windows and worked off in blocks of bounded size, so what is broadcast does not grow with
it; every document is read once per block.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, utf8

Q = 10
#: Edits per character of a window that still count as the same passage.
EDIT_RATE = 0.08
#: Longer items are looked for by windows of so many bytes, each half over the one before, and parts of all items by
#: short windows; any window is a hit.
WINDOW = 200
#: Windows for parts of items: bytes, and bytes from one to the next.
SHORT = 48
STEP = 12
#: Bytes of normalised benchmark text in one broadcast block; each is in some five windows.
BLOCK_BYTES = 1_000_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: Odd multiplier of the rolling q-gram code.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22


def normalise(text: bytes) -> bytes:
    """A-Z lower-cased; all ASCII but letters and digits is a blank; runs of blanks are one."""
    return b" ".join(text.translate(_FOLD).split())


def gram_codes(text: bytes, q: int = Q) -> np.ndarray:
    """A 64-bit code of each q-gram (equal grams have equal codes)."""
    n = len(text) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(q):
        code *= _BASE
        code += data[i:i + n] + np.uint64(1)
    return code ^ (code >> np.uint64(29))


def edit_budget(length: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed in a window: the rate, but no more than leave one q-gram that must be shared."""
    return max(0, min(int(rate * length), (length - q) // q))


def windows(length: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Cuts of an item, the long ones first; of each length the last window ends with the item."""
    def cuts(size: int, step: int) -> list[tuple[int, int]]:
        if length <= size:
            return [(0, length)]
        return [(s, s + size) for s in [*range(0, length - size, step), length - size]]

    return list(dict.fromkeys(cuts(window, window // 2) + cuts(min(SHORT, window), STEP)))


@dataclass
class Index:
    """Windows of a block of benchmark items, with the places of each q-gram."""
    items: list
    texts: list[bytes]
    part: list[bool]  # a short window for a part of its item
    budget: np.ndarray
    need: np.ndarray
    codes: np.ndarray  # sorted, different
    first: np.ndarray  # posting lists of codes: places [first[i], first[i + 1])
    window: np.ndarray
    place: np.ndarray
    longest: int
    maybe: np.ndarray  # one flag per code modulo 2 ** _FILTER_BITS

    @staticmethod
    def of(items: list[tuple[object, bytes]], q: int, rate: float, window: int) -> Index:
        names, texts, part = [], [], []
        for name, text in items:
            for lo, hi in windows(len(text), window):
                if hi - lo >= q:
                    names.append(name)
                    texts.append(text[lo:hi])
                    part.append(hi - lo < min(window, len(text)))
        budget = np.array([edit_budget(len(t), q, rate) for t in texts], np.int64)
        need = np.array([len(t) - q + 1 for t in texts], np.int64) - q * budget
        grams = [gram_codes(t, q) for t in texts]
        code = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(code, kind="stable")
        codes, first = np.unique(code[order], return_index=True)
        maybe = np.zeros(1 << _FILTER_BITS, bool)
        maybe[(codes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        return Index(names, texts, part, budget, need, codes, np.append(first, len(code)),
                     np.repeat(np.arange(len(texts)), [len(g) for g in grams])[order],
                     np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])[order],
                     max(map(len, texts), default=0), maybe)

    def hits(self, text: bytes, q: int) -> Iterator[tuple[int, int, int, int]]:
        """(window, start, end, edits) of windows that occur in `text`, by band, until their item is found without edits.

        Short windows only if no long one of their item occurs.
        """
        if not self.texts:
            return
        code = gram_codes(text, q)
        at = np.flatnonzero(self.maybe[(code & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        if not len(at):
            return
        number = np.searchsorted(self.codes, code[at])
        found = number < len(self.codes)
        found[found] = self.codes[number[found]] == code[at[found]]
        at, number = at[found], number[found]
        # the lemma without diagonals first: some span as long as the longest window has as many shared grams as any
        # window needs; other grams cannot belong to an occurrence
        span = self.longest + int(self.budget.max())
        count = np.searchsorted(at, at + span) - np.arange(len(at))
        starts = at[count >= self.need.min()]
        if not len(starts):
            return
        last = np.searchsorted(starts, at, side="right") - 1
        near = (last >= 0) & (at - starts[np.maximum(last, 0)] < span)
        at, number = at[near], number[near]
        many = self.first[number + 1] - self.first[number]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        entry = np.repeat(self.first[number], many) + within
        window, place = self.window[entry], self.place[entry]
        diagonal = np.repeat(at, many) - place
        half = self.budget[window] + 1
        band = np.floor_divide(diagonal, half)
        # each diagonal lies in two overlapping bands; different grams of the window count once per band
        low, wide, long = int(band.min()) - 1, int(band.max() - band.min()) + 2, self.longest
        key = (window * wide + band - low) * long + place
        if 2 * len(self.texts) * wide * long > 1 << 62:
            raise ValueError("the text is too long for the block size of the benchmark")
        key = np.sort(np.concatenate([key, key - long]))
        group = key[np.append(True, key[1:] != key[:-1])] // long
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        shared = np.diff(np.append(begin, len(group)))
        group, whole, long_found = group[begin], set(), set()
        for i in np.flatnonzero(shared >= self.need[group // wide]):
            w, b = int(group[i] // wide), int(group[i] % wide) + low
            if self.items[w] in whole or self.part[w] and self.items[w] in long_found:
                continue
            pattern, e = self.texts[w], int(self.budget[w])
            low_d, high_d = b * (e + 1) - e, (b + 2) * (e + 1) + e
            exact = text.find(pattern, max(0, low_d), max(0, high_d) + len(pattern))
            edits, end = (0, exact + len(pattern)) if exact >= 0 else banded_distance(pattern, text, low_d, high_d)
            if edits <= e:
                if not self.part[w]:
                    long_found.add(self.items[w])
                yield w, max(0, end - len(pattern)), end, edits
            if edits == 0:
                whole.add(self.items[w])  # no place of this item can be better


def banded_distance(pattern: bytes, text: bytes, low: int, high: int) -> tuple[int, int]:
    """Least edits between `pattern` and any part of `text` along diagonals low..high-1, and where that part ends."""
    far = len(pattern) + len(text) + 1
    diagonal = np.arange(low, high)
    padded = np.frombuffer(text, np.uint8)
    cost = np.where((diagonal >= 0) & (diagonal <= len(text)), 0, far)  # a part may start anywhere
    step = np.arange(len(diagonal))
    for row, byte in enumerate(pattern):
        column = diagonal + row  # text position that this row's diagonals read
        inside = (column >= 0) & (column < len(text))
        same = np.zeros(len(diagonal), bool)
        same[inside] = padded[column[inside]] == byte
        fresh = np.where(inside, cost + ~same, far)
        fresh[:-1] = np.minimum(fresh[:-1], cost[1:] + 1)  # a byte of the pattern is missing
        fresh[(column + 1 < 0) | (column + 1 > len(text))] = far
        cost = np.minimum.accumulate(fresh - step) + step  # bytes of the text that the pattern lacks
        cost[(column + 1 < 0) | (column + 1 > len(text))] = far
    best = int(np.argmin(cost))
    return int(cost[best]), int(diagonal[best] + len(pattern))


def blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """Benchmark items in blocks of at most `block_bytes` (or one item), read through the driver one after another."""
    held, size = [], 0
    for row in benchmark.select(item_id, text).filter(F.col(text).isNotNull()).toLocalIterator():
        item = normalise(row[1].encode())
        if held and size + len(item) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row[0], item))
        size += len(item)
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", q: int = Q, rate: float = EDIT_RATE,
                 window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, edits): one row per document and item found in it, at its best place.

    Places count bytes of the normalised text; of an item of which only a part is found, they are those of the best short
    window. An item shorter than q normalised bytes cannot be told from chance and
    is never found; null texts hold nothing; repeated documents or items give repeated rows; of equally good places
    the first counts. An empty benchmark or table gives no rows.
    """
    kinds = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}"
    schema = f"{kinds}, start bigint, end bigint, edits int"
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast((_index(block, q, rate, window), [name for name, _ in block]))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch in slices(batches):
                rows = []
                for row, t in enumerate(utf8(batch.column(1))):
                    best: dict[int, tuple[int, int, int]] = {}
                    for w, start, end, edits in index.hits(normalise(t), q):
                        n = index.items[w]
                        best[n] = min(best.get(n, (edits, start, end)), (edits, start, end))
                    rows += [(row, names[n], *found) for n, found in sorted(best.items())]
                if rows:
                    at, item, edits, start, end = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(item), pa.array(start, pa.int64()),
                         pa.array(end, pa.int64()), pa.array(edits, pa.int32())],
                        ["doc_id", "item_id", "start", "end", "edits"])

        part = docs.select(doc_id, text).mapInArrow(work, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          q: int = Q, rate: float = EDIT_RATE, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, in which no benchmark item is found; block after block of the benchmark."""
    place = docs.columns.index(text)
    for block in blocks(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(_index(block, q, rate, window))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                free = [next(shared.value.hits(normalise(t), q), None) is None for t in utf8(batch.column(place))]
                yield batch.filter(pa.array(free, pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def _index(block: list[tuple[object, bytes]], q: int, rate: float, window: int) -> Index:
    return Index.of([(n, t) for n, (_, t) in enumerate(block)], q, rate, window)  # repeated items stay apart
