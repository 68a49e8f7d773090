"""Personal data: base patterns, and generated candidates that boosted trees accept.

Generators propose many overlapping spans: anything with an at sign or spelled-out address, groups of digits, dotted
numbers, groups of hexadecimal digits between colons. Boosted trees judge each by its format and the words around it. They learn from candidates of all documents: those that a base
pattern confirms, the same with the mark that gives them away rubbed out (a phone number without its plus, an address
with a spelled-out at sign and dots, an address of version 6), and candidates that no base pattern confirms. Equal candidates are counted, not repeated.
A level of a tree is one Spark job that adds up gradients by node, feature and bin; the driver gets these sums only, whose number does not depend on the input. Scores are calibrated on documents
kept apart, and the threshold is the lowest score with the wanted precision there. Accepted spans are added to the base ones.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table
from .common import map_batches
from .spans import Span, Taken, mark

KINDS = ["email", "ip", "card", "phone"]
LIKELY = "likely"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match always starts at the start of its digits, so other starts need no try
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = r"(?:\s?[(\[{]\s?(?:@|(?i:at))\s?[)\]}]\s?|\s(?i:at)\s|@)"
_DOT = r"(?:\s?[(\[{]\s?(?:\.|(?i:dot))\s?[)\]}]\s?|\s(?i:dot)\s|\.)"
_GENERATORS = [  # lengths of the parts of an address are those that the standard allows
    re.compile(r"(?<![^\s@])[^\s@]+@[^\s@]+"),
    re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}"),
    re.compile(r"\+?\(?[0-9][0-9\x20().-]{5,}[0-9]"),
    re.compile(r"(?<![0-9])[0-9]+(?:\[?[.:]\]?[0-9]+){3}"),
    re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}::?|::)(?:[0-9A-Fa-f]{1,4}::?){1,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z])"),
]
#: What every match of the first two generators holds.
_ADDRESS = re.compile(r"@|[(\[{\s](?i:at)[)\]}\s]")
_WORDS = (("phone", "tel", "call", "fax", "mobile"), ("mail", "contact", "write"), ("card", "visa", "account", "pay"), ("ip", "host", "server"))
CONTEXT = 24
ROUNDS, DEPTH, RATE, BINS, LEAST_LEAF = 60, 3, 0.2, 32, 20
PRECISION = 0.98
#: Gradients are added up as multiples of 1 / UNITS: whole numbers, so that the sums do not depend on the order of rows.
UNITS = 2 ** 24
#: Different binned candidates that one task adds up at least, so that its sums are not more rows than it read.
ROWS_A_TASK = 4000
#: Scores are calibrated by steps of 1 / STEPS.
STEPS = 1000


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from their at signs in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [(start, 0, end, True) for start, end in _emails(text)]
    out += [(m.start(), 1, m.end(), True) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    out += [(m.start(), 2, m.end(), True) for m in _CARD.finditer(text)
            if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end(), True) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Different spans of all generators, in order."""
    found = set()
    for number, generator in enumerate(_GENERATORS):
        if number >= 2 or _ADDRESS.search(text):
            found.update(m.span() for m in generator.finditer(text))
    return sorted(found)


def features(span: str, before: str, after: str) -> list[float]:
    """Format of the span and the words around it."""
    digits = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    words = before.lower()
    return [len(span), len(digits), sum(c.isalpha() for c in span), sum(c.isupper() for c in span), span.count("."),
            span.count(" "), span.count("-"), span.count("(") + span.count(")"), span.count("@"), float(span.startswith("+")),
            float(bool(re.search(r"(?i)\bat\b", span))), float(bool(re.search(r"(?i)\bdot\b", span))),
            span.count(":"), span.count("["), len(groups), max(groups), groups[0], groups[-1],
            float(14 <= len(digits) <= 19 and luhn(digits)), float(len(groups) == 4 and max(groups) <= 3), len(set(digits)),
            float(before[-1:].isalnum()), float(after[:1].isalnum()), *(float(any(w in words for w in ws)) for ws in _WORDS)]


def _around(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - CONTEXT):start], text[end:end + 1]


def rubbed_out(span: str, kind: int) -> list[str]:
    """Forms of a base span without the mark that its pattern goes by."""
    if kind == 0:
        local, domain = span.split("@", 1)
        return [f"{local} at {domain.replace('.', ' dot ')}", f"{local} at {domain}", f"{local} [at] {domain}",
                f"{local} At {domain.replace('.', ' Dot ')}"]
    if kind == 1:
        a, b, c, d = (int(x) & 255 for x in span.split("."))
        return [span.replace(".", "[.]"), f"2001:db8::{a:x}{b:02x}:{c:x}{d:02x}", f"fe80:{a:x}:{b:x}:{c:x}:{d:x}:1:2:3"]
    return [re.sub(r"^\+[0-9]{1,3}\x20?", "", span)] if kind == 3 else [span.replace(" ", "-")]


def labelled(text: str) -> Iterator[tuple[int, list[float]]]:
    """(label, features) of all candidates of a text and of rubbed-out base spans."""
    base = base_spans(text)
    taken = Taken(base)
    for start, kind, end, _ in base:
        span, before, after = _around(text, start, end)
        yield 1, features(span, before, after)
        for form in rubbed_out(span, kind):
            yield 1, features(form, before, after)
    for start, end in candidates(text):
        if not taken.overlaps(start, end):
            yield 0, features(*_around(text, start, end))


@dataclass
class Trees:
    """Boosted trees over binned features, with calibrated probabilities by steps of the score."""
    cuts: list[np.ndarray]  # at most BINS - 1 for each feature
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature and bin of each inner node, value of each leaf
    start: float
    edges: np.ndarray
    precision: np.ndarray
    threshold: float = np.inf

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for feature, cut, value in self.trees:
            out += value[_leaf(bins, feature, cut)]
        return out

    def accepts(self, x: np.ndarray) -> np.ndarray:
        return self.raw(self.binned(x)) >= self.threshold


def _leaf(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return _node(bins, feature, cut, DEPTH)


def _sums(bins: np.ndarray, node: np.ndarray, nodes: int, weights: list[np.ndarray]) -> np.ndarray:
    """Sums of each of the weights by node, feature and bin."""
    return np.stack([np.stack([np.bincount(node * BINS + b, w, nodes * BINS).reshape(nodes, BINS) for b in bins.T], axis=1)
                     for w in weights], axis=-1)


def _node(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Place of each row among the nodes of a level."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(level):
        node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
    return node - (2 ** level - 1)


def grow(sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree of full depth by second-order gain; a node that no split improves sends all rows left.

    `sums(feature, cut, level)` gives gradient, hessian and rows of the nodes of a level, by node, feature and bin.
    """
    inner = 2 ** DEPTH - 1
    feature, cut, value = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64), np.zeros(inner + 1)
    for level in range(DEPTH):
        for n, found in enumerate(sums(feature, cut, level), 2 ** level - 1):
            total, below = found[0].sum(axis=0), np.cumsum(found, axis=1)[:, :-1]
            (g, h, many), above = np.moveaxis(below, -1, 0), total - below
            gain = g ** 2 / (h + 1) + above[..., 0] ** 2 / (above[..., 1] + 1) - total[0] ** 2 / (total[1] + 1)
            gain[(many < LEAST_LEAF) | (above[..., 2] < LEAST_LEAF)] = 0
            f, c = divmod(int(np.argmax(gain)), BINS - 1)
            left = total
            if gain[f, c] > 1e-6:
                feature[n], cut[n], left = f, c, below[f, c]
            if level == DEPTH - 1:
                leaf = 2 * n + 1 - inner
                for at, (g, h, _) in ((leaf, left), (leaf + 1, total - left)):
                    value[at] = RATE * g / (h + 1)
    return feature, cut, value


def _grow(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`grow` over rows at hand."""
    return grow(lambda feature, cut, level: _sums(bins, _node(bins, feature, cut, level), 2 ** level, [gradient, hessian, np.ones(len(bins))]))


def calibrate(score: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic steps: (lowest score, share of label 1) of each step, both rising. Equal scores share a step.

    `y` is the number of label 1 among the `rows` (one if not given) of a score.
    """
    values, at = np.unique(score, return_inverse=True)
    steps: list[tuple[float, float, float]] = []  # lowest score, sum of labels, rows
    for value, ones, many in zip(values, np.bincount(at, y), np.bincount(at, rows)):
        while steps and steps[-1][1] * many >= ones * steps[-1][2]:
            value, before, held = steps.pop()
            ones, many = ones + before, many + held
        steps.append((value, ones, many))
    return np.array([s[0] for s in steps]), np.array([s[1] / s[2] for s in steps])


def _seen(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(label, apart, x, n): the different labelled candidates of all documents, and how often they occur."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        many = Counter((label, apart, tuple(map(int, x))) for t, apart in zip(*(c.to_pylist() for c in batch.columns))
                       for label, x in labelled(t))
        label, apart, x = zip(*many) if many else ((), (), ())
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((label, apart, x, list(many.values())), kinds)], ["label", "apart", "x", "n"])

    texts = docs.filter(F.col(text).isNotNull()).select(text, (F.pmod(F.xxhash64(doc_id), F.lit(4)) == 0).cast("int").alias("apart"))
    rows = map_batches(texts, work, "label int, apart int, x array<int>, n long")
    return rows.groupBy("label", "apart", "x").agg(F.sum("n").alias("n"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _cuts(seen: DataFrame) -> list[np.ndarray]:
    """Quantiles of each feature over all candidates."""
    shares = [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]
    found = seen.agg(*[F.percentile(F.col("x")[f], shares, F.col("n")) for f in range(len(features("", "", "")))]).first()
    return [np.unique(np.array(quantiles or [], np.float64)) for quantiles in found]


def _binned(seen: DataFrame, model: Trees) -> DataFrame:
    """(label, apart, bins, n) of the different binned candidates."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bins = model.binned(_matrix(batch.column(2), batch.num_rows)) if batch.num_rows else []
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(bins), pa.list_(pa.int8())), batch.column(3)],
                                          ["label", "apart", "bins", "n"])

    rows = map_batches(seen, work, "label int, apart int, bins array<tinyint>, n long")
    return rows.groupBy("label", "apart", "bins").agg(F.sum("n").alias("n"))


def _level_sums(rows: DataFrame, model: Trees, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """What `grow` asks for, of all rows, with the gradients that the trees so far leave."""
    shape = (2 ** level, len(model.cuts), BINS, 3)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                y, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
                bins = _matrix(batch.column(1), batch.num_rows)
                p = 1 / (1 + np.exp(-model.raw(bins)))
                weights = [n * np.rint(UNITS * v) for v in (y - p, p * (1 - p))]
                total += _sums(bins, _node(bins, feature, cut, level), shape[0], [*weights, n])
        cells = np.flatnonzero(total.reshape(-1, 3)[:, 2])
        columns = total.reshape(-1, 3)[cells].astype(np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (cells, *columns)], ["cell", "g", "h", "n"])

    found = (rows.select("label", "bins", "n").mapInArrow(work, "cell long, g long, h long, n long")
             .groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect())
    out = np.zeros((shape[0] * shape[1] * shape[2], 3))
    for cell, g, h, n in found:
        out[cell] = g / UNITS, h / UNITS, n
    return out.reshape(shape)


def _scores(rows: DataFrame, model: Trees) -> np.ndarray:
    """(score, rows of label 1, rows), a row for each step of the score."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        step = np.floor(STEPS * model.raw(_matrix(batch.column(1), batch.num_rows))).astype(np.int64) if batch.num_rows else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(step), batch.column(2)], ["label", "step", "n"])

    found = (map_batches(rows.select("label", "bins", "n"), work, "label int, step long, n long").groupBy("step")
             .agg(F.sum(F.col("label") * F.col("n")), F.sum("n")).collect())
    return np.array([(step / STEPS, ones, n) for step, ones, n in found]).reshape(-1, 3)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", precision: float = PRECISION) -> Trees:
    """Learn from the candidates of all documents, calibrate on a quarter of the documents, by hash of the id.

    The threshold is the lowest score whose calibrated probability reaches the precision; without candidates of both
    kinds on both sides nothing is accepted.
    """
    seen = stage_table(_seen(docs, doc_id, text), "candidates")
    model = Trees(_cuts(seen), [], 0.0, np.zeros(0), np.zeros(0))
    rows = stage_table(_binned(seen, model), "binned")
    found = rows.groupBy("apart", "label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different")).collect()
    many = {(r.apart, r.label): r.n for r in found}
    if len(many) < 4:
        return model
    model.start = float(np.log(many[0, 1] / many[0, 0]))
    learnt = rows.filter("apart = 0").coalesce(-(-sum(r.different for r in found) // ROWS_A_TASK))
    for _ in range(ROUNDS):
        model.trees.append(grow(lambda feature, cut, level: _level_sums(learnt, model, feature, cut, level)))
    score, ones, n = _scores(rows.filter("apart = 1"), model).T
    model.edges, model.precision = calibrate(score, ones, n)
    good = model.edges[model.precision >= precision]
    model.threshold = float(good[0]) if len(good) else np.inf
    return model


def find(text: str, model: Trees) -> list[Span]:
    """Base spans, and accepted candidates apart from them; of overlapping candidates the longest, then the first."""
    spans = base_spans(text)
    taken = Taken(spans)
    found = [c for c in candidates(text) if not taken.overlaps(*c)]
    if not found:
        return spans
    accepted = model.accepts(np.array([features(*_around(text, *c)) for c in found]))
    added: list[Span] = []
    taken = Taken()
    for start, end in sorted((c for c, yes in zip(found, accepted) if yes), key=lambda c: (c[0] - c[1], c)):
        if not taken.overlaps(start, end):
            taken.add(start, end)
            added.append((start, len(KINDS), end, False))
    return spans + added


def scan(docs: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; a null or empty text has none, repeated rows come out repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return mark(docs, lambda t: find(t, shared.value), [*KINDS, LIKELY], doc_id, text)
