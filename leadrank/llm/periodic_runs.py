"""Runs of repeated word sequences (a b c a b c a ...) by a suffix automaton with link-cut access.

The suffix links of a text's automaton form a tree in which the path from a prefix's state to the root holds all
suffixes of that prefix. Each word that is appended in turn recolours the path of its prefix with its own number, by
access in a link-cut tree. Before that, the path falls into segments of one colour: the deepest state of a segment with
colour e gives the longest suffix, L words, that has ended last at e. If the two ends are at most L apart, they enclose
a square: the text ending here has period d = end - e over L + d >= 2 * d words. No shorter period does, as it would
have given a later last end; and no longer suffix ends at e, so the run begins there. It is followed to the right, once.

Paths need amortised O(log n) segments, so a text of n words takes O(n log n) steps, however often it repeats.

Only stretches of a text are looked at that words of a run can be in: every word of a run of at least 12 words stands in
a window of six words that occurs a period earlier or later. So runs lie in stretches covered by windows that the text
holds twice. Windows are compared by hashes; equal hashes of different windows only make a stretch longer.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, utf8

#: Words of the shortest run.
LEAST = 12
TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_FACTOR = 0x9E3779B97F4A7C15


def automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of each state, and the state of each prefix. State 1 is the root, 0 is none."""
    step: list[dict] = [{}, {}]
    link, longest, prefixes = [0, 0], [0, 0], []
    last = 1
    for word in words:
        new = len(link)
        prefixes.append(new)
        step.append({})
        link.append(1)
        longest.append(longest[last] + 1)
        at = last
        while at and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at:
            found = step[at][word]
            if longest[found] == longest[at] + 1:
                link[new] = found
            else:
                copy = len(link)
                step.append(step[found].copy())
                link.append(link[found])
                longest.append(longest[at] + 1)
                link[found] = link[new] = copy
                while at and step[at].get(word) == found:
                    step[at][word] = copy
                    at = link[at]
        last = new
    return link, longest, prefixes


class Paths:
    """A tree whose paths to the root are recoloured: link-cut access by splay trees, one for each run of one colour.

    A splay tree holds the states of its path by depth; its top keeps the colour, and points at the path above.
    """

    def __init__(self, parent: list[int]):
        self.up = list(parent)  # splay parent, or for the top of a splay tree the state above its path
        self.left = [0] * len(parent)
        self.right = [0] * len(parent)
        self.colour = [0] * len(parent)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p] = x
        up[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self.colour[x] = self.colour[g]  # only that of the top counts
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                self.colour[x] = self.colour[p]
            self._rotate(x)

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """Colour the path from `state` to the root; (colour, deepest state) of the segments it had, from below."""
        below, x, segments = 0, state, []
        while x:
            self._splay(x)
            segments.append((self.colour[x], x))
            cut = self.right[x]
            if cut:
                self.colour[cut] = self.colour[x]
            self.right[x] = below
            if below:
                self.up[below] = x
            below, x = x, self.up[x]
        self.colour[below] = colour
        return segments


def squares(words: list) -> Iterator[tuple[int, int, int]]:
    """(end, period, start): words[start..end] has this smallest period, at least twice over, and begins nowhere earlier."""
    link, longest, prefixes = automaton(words)
    paths = Paths(link)
    for end, state in enumerate(prefixes, 1):
        for before, deepest in paths.access(state, end):
            if before and longest[deepest] >= end - before:
                yield end - 1, end - before, before - longest[deepest]


def runs_of(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of `least` words or more, by start, then period."""
    reached: dict[int, int] = {}  # by period, the end of its latest run
    found = []
    for end, period, start in squares(words):
        if end > reached.get(period, -1):
            while end + 1 < len(words) and words[end + 1] == words[end + 1 - period]:
                end += 1
            reached[period] = end
            if end - start + 1 >= least:
                found.append((start, end - start + 1, period))
    return sorted(found)


def _stretches(words: list[bytes], least: int) -> list[tuple[int, int]]:
    """Parts of the text that hold all its runs: those covered by windows of half a run's words that occur twice."""
    width = max(1, least // 2)
    many = len(words) - width + 1
    if many < 2:
        return []
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(many, np.uint64)
    for k in range(width):
        window = window * np.uint64(_FACTOR) + codes[k:k + many]
    order = np.argsort(window, kind="stable")
    twin = window[order[1:]] == window[order[:-1]]
    if not twin.any():
        return []
    again = np.zeros(many, bool)
    again[order[1:][twin]] = again[order[:-1][twin]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    covered = np.cumsum(change) > 0
    edges = np.flatnonzero(covered[1:] != covered[:-1]) + 1
    edges = np.append(0, edges) if covered[0] else edges
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def find(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of `words`, by start, then period."""
    return [(a + s, n, q) for a, b in _stretches(words, least) for s, n, q in runs_of(words[a:b], least)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run contains after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start, then period, and its text with each run cut to one period.

    Words are what blanks and the characters 9-13 leave; a null, empty or blank text has none, and its collapsed text
    is empty. Repeated rows and rows without an id are judged like any other; other columns of `docs` are not read.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, kept = [], []
        for t in utf8(batch.column(1)):
            words = t.split()  # on bytes: blank and 9-13
            runs = find(words, least)
            out.append(runs)
            kept.append(collapsed(words, runs))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _ARROW), pa.array(kept, pa.binary()).cast(pa.string())],
                                          ["doc_id", "runs", "collapsed"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(docs.select(doc_id, text), work, f"doc_id {kind}, runs {TYPE}, collapsed string")


def digest(marked: DataFrame) -> DataFrame:
    """The number of runs, the longest one (ties: smallest start, then period), and hashes of all runs and of the rest."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return marked.withColumn("_longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"), (-F.col("_longest.period")).alias("period"),
        F.expr("1000 * _longest.length div -_longest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
