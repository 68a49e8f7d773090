"""Secrets in texts: base patterns, and tokens that look more like random strings than like identifiers.

Two first-order character models are learnt from labelled samples, over all documents: values that the base patterns
caught are random strings; all other words, and pairs of neighbouring words joined in camel case, are ordinary
identifiers. Both are interpolated with the same plain distribution of characters, so a pair that neither has seen says
nothing. The marks / _ - = part an identifier: each part begins anew. A token counts as a secret if the log-likelihood
ratio of the two models outweighs the prior odds and it has enough different characters (a ruler has not).
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, slices
from .spans import Span, Taken, mark, redact

KINDS = ["assign", "access", "hex"]
RANDOM = "random"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_WORDS = ("passw", "secret", "token", "api")  # one of them is in every match, in some case
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the longest runs, so the same as runs of any length that are then measured
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Characters of ALPHABET that count; the marks after them only part.
INNER = 63
#: Share of the plain distribution in the model of random strings and in that of identifiers.
RANDOM_PLAIN, ORDINARY_PLAIN = 0.5, 0.1
#: Different characters that a random token has at least.
DIFFERENT = 8
#: A token is taken to be random once in so many.
PRIOR_ODDS = 10_000.0
MASK = "[SECRET]"

START = len(ALPHABET)  # row of the table for the first character of a part
_OUT = START + 1
_CODE = np.full(129, _OUT, np.intp)  # the last place stands for all other characters
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i


def _codes(text: str) -> np.ndarray:
    """Number of each code point in ALPHABET, or _OUT."""
    return _CODE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


def _before(codes: np.ndarray) -> np.ndarray:
    """The row of the table that each character is looked up in."""
    before = np.full(len(codes), START)
    before[1:] = np.where(codes[:-1] < INNER, codes[:-1], START)
    return before


def base_spans(text: str) -> list[tuple[int, int, int, bool, str]]:
    """Spans of the base patterns with the caught value."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end(), True, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), True, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [(m.start(), 2, m.end(), True, m[0]) for m in _HEX.finditer(text)]


@dataclass
class Ratio:
    """Log-likelihood ratio of each pair of characters: random string against identifier."""
    table: np.ndarray

    @staticmethod
    def of(random: np.ndarray, ordinary: np.ndarray) -> Ratio:
        """From pair counts, rows by first character (START for none). Without any, every ratio is even."""
        random, ordinary = (np.asarray(x, float)[:, :INNER] for x in (random, ordinary))
        pooled = (random.sum(0) + 1) / (random.sum() + INNER) + (ordinary.sum(0) + 1) / (ordinary.sum() + INNER)
        plain = pooled / 4 + 0.5 / INNER

        def mixed(counts: np.ndarray, share: float) -> np.ndarray:
            total = counts.sum(1, keepdims=True)
            return np.where(total > 0, (1 - share) * counts / np.maximum(total, 1) + share * plain, plain)

        table = np.zeros((START + 2, _OUT + 1))
        table[:START + 1, :INNER] = np.log(mixed(random, RANDOM_PLAIN)) - np.log(mixed(ordinary, ORDINARY_PLAIN))
        return Ratio(table)

    def of_token(self, token: str) -> float:
        codes = _codes(token)
        return float(self.table[_before(codes), codes].sum())


def pair_counts(texts: list[str]) -> np.ndarray:
    """(2, rows, characters): pairs in labelled samples of ordinary identifiers (0) and random strings (1)."""
    random, plain = [], []
    for text in texts:
        found = base_spans(text)
        random += [value for *_, value in found]
        plain.append(redact(text, [s[:4] for s in found], "\x00") if found else text)
    counts = np.zeros((2, START + 1, START), np.int64)
    for label, joined in ((0, "\n".join(plain)), (1, "\n".join(random))):
        codes = _codes(joined)
        pairs = [(_before(codes), codes)]
        if label == 0:  # words also stand for the identifiers that are made of them
            inner = codes < INNER
            starts = np.flatnonzero(inner & np.append(True, ~inner[:-1])) if len(codes) else np.zeros(0, np.intp)
            ends = np.flatnonzero(inner & np.append(~inner[1:], True)) if len(codes) else starts
            upper = np.where(codes[starts] < 26, codes[starts] + 26, codes[starts])
            longer = ends > starts
            pairs += [(codes[ends[:-1]], upper[1:]), (upper[longer], codes[starts[longer] + 1])]
        for a, b in pairs:
            fits = b < INNER
            counts[label] += np.bincount(a[fits] * START + b[fits], minlength=(START + 1) * START).reshape(START + 1, START)
    return counts


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Ratio:
    """Learn both models from all documents. Without any, both are even and no token is a secret."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = pair_counts([t or "" for t in batch.column(0).to_pylist()]).ravel()
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["cell", "n"])

    counts = np.zeros(2 * (START + 1) * START)
    for row in map_batches(docs.select(text), work, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row.cell] = row.n  # one row a cell
    ordinary, random = counts.reshape(2, START + 1, START)
    return Ratio.of(random, ordinary)


def find(text: str, ratio: Ratio, odds: float = PRIOR_ODDS) -> list[Span]:
    """Base spans, and tokens apart from them whose ratio outweighs the prior odds."""
    spans = [s[:4] for s in base_spans(text)]
    codes = _codes(text)
    if not len(codes):
        return spans
    edges = np.flatnonzero(np.diff(np.concatenate([[False], codes < START, [False]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    total = np.append(0, np.cumsum(ratio.table[_before(codes), codes]))
    at = np.flatnonzero((end - start >= DIFFERENT) & (total[end] - total[start] > np.log(odds)))
    if len(at):
        taken = Taken(spans)
        spans += [(a, len(KINDS), b, False) for a, b in zip(start[at].tolist(), end[at].tolist())
                  if len(np.unique(codes[a:b][codes[a:b] < INNER])) >= DIFFERENT and not taken.overlaps(a, b)]
    return spans


def scan(docs: DataFrame, ratio: Ratio, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; a null or empty text has none, repeated rows come out repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    return mark(docs, lambda t: find(t, shared.value), [*KINDS, RANDOM], doc_id, text)


def redacted(docs: DataFrame, ratio: Ratio, text: str = "text", mask: str = MASK) -> DataFrame:
    """`docs` with every secret in `text` replaced by `mask`; all other columns and texts stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    place = docs.columns.index(text)

    def clean(t: str | None) -> str | None:
        return t and redact(t, find(t, shared.value), mask)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.set_column(place, text, pa.array([clean(t) for t in batch.column(place).to_pylist()], pa.string()))

    return docs.mapInArrow(lambda batches: map(work, slices(batches)), docs.schema)
