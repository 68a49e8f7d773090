"""Toxic passages: maximum-scoring segments of token log-odds, judged by an extreme-value law.

1. Token log-odds. Every word counts under its beginnings of 3 to 10 letters and as a whole, by label. The class rates
   have nested Dirichlet priors: those of a longer beginning are centred on the posterior of the shorter one, with the
   weight of `PRIOR` words. A word takes the log-odds of the longest of its beginnings that is known, less `DRIFT`, so that
   ordinary text sums up to less than zero.
2. Segments. One scan over the words (Ruzzo and Tompa, 1999) finds all maximal-scoring segments of a text.
3. Extreme values. In ordinary text of n words, a segment of score S or more is met K * n * exp(-lambda * S) times on
   average (Karlin and Altschul, 1990). lambda and K are fitted by likelihood to the best segments of all rows of the
   calibration fold that are labelled not toxic. A segment with E = K * n * exp(-lambda * S) <= SIGNIFICANT is a passage.
4. Score. The evidence of a text is -log of the chance that ordinary text has r segments whose scores add up so high
   (Karlin and Altschul, 1993), for the number r of best segments that makes it most unlikely, each further segment at the
   price of a factor 2. A logistic curve, fitted to all labelled rows of the calibration fold, turns it into a probability.

Words are counted on at most `LABELLED` rows of each label, those with the smallest hashes of their ids; everything else
covers all rows. The rows of fold 0 are never learnt from, those of fold `CALIBRATION` are kept from the counts.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage_table
from .common import slices

FOLDS, CALIBRATION = 5, 4
#: Labelled rows of each label whose words are counted, at most.
LABELLED = 4000
#: Beginnings that are kept at most, the most frequent ones, and times that a beginning has to be seen.
GRAMS, SEEN = 1 << 18, 4
#: A word counts so often in one text at most, so that no text makes a word's odds by itself.
IN_ONE_TEXT = 3
SHORTEST, LONGEST, WHOLE = 3, 10, 40
PRIOR = 10.0
DRIFT = 1.0
#: Log-odds that a prior has at most.
MOST = 8.0
SIGNIFICANT = 0.05
THRESHOLD = 0.5
#: Different words whose scores a Python worker remembers.
WORDS_KEPT = 400_000
#: Width of the bins of scores and of evidence that fits read, so that the driver gets a bounded table.
BIN = 0.05
_WORD = re.compile(r"[^\W\d_]+")
TYPE = "array<struct<start: bigint, end: bigint, score: double>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def fold(doc_id: Column) -> Column:
    """Rest of the crc32 of the id as text. A null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def grams(word: str) -> list[str]:
    """The beginnings of a word, shortest first, and at last the word itself, marked by a blank."""
    word = word[:WHOLE].lower()
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)] + [word + " "]


def log_odds(counts: Iterable[tuple[str, int, int]], words: tuple[int, int]) -> dict[str, float]:
    """Log-odds of each beginning from its counts in ordinary and in toxic texts; `words` are the counts of all words."""
    ordinary, toxic = words
    found: dict[str, float] = {}
    for gram, c0, c1 in sorted(counts, key=lambda r: (r[0][-1:] == " ", len(r[0]), r[0])):
        shorter = (gram[:k] for k in range(min(len(gram.rstrip(" ")) - 1, LONGEST), SHORTEST - 1, -1))
        prior = max(-MOST, min(MOST, next((found[g] for g in shorter if g in found), 0.0)))
        part = math.exp(prior) * toxic / (math.exp(prior) * toxic + ordinary)
        found[gram] = math.log((c1 + PRIOR * part) / toxic) - math.log((c0 + PRIOR * (1 - part)) / ordinary)
    return found


class Scores(dict):
    """Score of each word, made when it is first asked for."""

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: str) -> float:
        if len(self) > WORDS_KEPT:
            self.clear()
        best = 0.0
        for gram in reversed(grams(word)):
            if gram in self.odds:
                best = self.odds[gram]
                break
        self[word] = best = best - DRIFT
        return best


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, end, score) of all maximal-scoring segments of positive score, in linear time."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.cumsum(scores)
    right = total[at].tolist()
    left = (total[at] - scores[at]).tolist()
    kept: list[tuple[int, int, float, float, int]] = []  # first, end, sums before and after, place of the next lower sum before
    for i, lo, hi in zip(at.tolist(), left, right):
        first, end = i, i + 1
        place = len(kept) - 1
        while True:
            while place >= 0 and kept[place][2] >= lo:
                place = kept[place][4]
            if place < 0 or kept[place][3] >= hi:
                kept.append((first, end, lo, hi, place))
                break
            first, _, lo, _, before = kept[place]  # it goes on to here
            del kept[place:]
            place = before
    return [(first, end, hi - lo) for first, end, lo, hi, _ in kept]


def on_curve(evidence: float) -> float:
    """Evidence as the logistic curve sees it: large values count by their logarithm."""
    return math.log1p(evidence)


@dataclass
class Model:
    odds: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0     # lambda
    log_k: float = 0.0
    offset: float = 0.0   # of the logistic curve
    slope: float = 0.0

    def evidence(self, scores: np.ndarray, words: int) -> float:
        """Of a text of so many words, from the scores of its segments. What is to be expected is no evidence."""
        if not len(scores):
            return 0.0
        excess = self.rate * np.sort(scores)[::-1] - self.log_k - math.log(words)
        many = np.arange(1, len(scores) + 1)
        total = np.cumsum(excess)
        choices = np.append(0, np.cumsum(np.log(many)))  # log of factorials
        above = np.maximum(total, 1)
        unlikely = np.where(total > 1, above - (many - 1) * np.log(above) + choices[many] + choices[many - 1], excess[0])
        return max(0.0, float((unlikely - many * math.log(2)).max()))

    def significant(self, score: float, words: int) -> bool:
        return self.log_k + math.log(words) - self.rate * score <= math.log(SIGNIFICANT)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-(self.offset + self.slope * on_curve(evidence))))


def extreme_law(cells: Iterable[tuple[float, float, float]]) -> tuple[float, float]:
    """(lambda, log K) of best segments: cells of (words, best score, texts); a best score of 0 stands for none."""
    cells = np.array(list(cells), float).reshape(-1, 3)
    n, x, many = cells.T
    met = many * (x > 0)
    if met.sum() == 0 or (x[x > 0].min() == x.max()):
        return 1.0, 0.0

    def likelihood(rate: float) -> tuple[float, float]:
        mean = (many * n * np.exp(-rate * x)).sum()
        log_k = math.log(met.sum() / mean)
        return (met * (log_k + np.log(n * rate) - rate * x)).sum() - met.sum(), log_k

    lo, hi = 1e-3, 50.0
    for _ in range(80):  # the likelihood has one maximum
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (a, hi) if likelihood(a)[0] < likelihood(b)[0] else (lo, b)
    return lo, likelihood(lo)[1]


def logistic(cells: Iterable[tuple[float, float, float]]) -> tuple[float, float]:
    """(offset, slope >= 0) of the curve through cells of (x, texts, toxic texts), with one text of each label added."""
    cells = np.array(list(cells) + [(0.0, 2.0, 1.0)], float)
    x, many, toxic = cells.T
    w = np.array([math.log((toxic.sum()) / (many.sum() - toxic.sum())), 0.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (toxic - many * p) - np.array([0, 1e-3]) * w
        curve = (design * (many * p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-3])
        move = np.linalg.solve(curve, slope)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[1] > 0 else (math.log(toxic.sum() / (many.sum() - toxic.sum())), 0.0)


def _known(labels: DataFrame, label: str) -> DataFrame:
    """(id, label) of the labelled ids that may be learnt from; an id with both labels counts as toxic."""
    return (labels.filter(F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy(F.col("doc_id").alias("_id"))
            .agg(F.max(label).cast("int").alias("_label")))


def _counted(docs: DataFrame, known: DataFrame, doc_id: str, text: str) -> tuple[list[tuple[str, int, int]], tuple[int, int]]:
    """Counts of beginnings on a bounded number of labelled texts, and of all words."""
    some = [known.filter((fold(F.col("_id")) != CALIBRATION) & (F.col("_label") == y)).orderBy(F.xxhash64("_id"), "_id").limit(LABELLED)
            for y in (0, 1)]
    chosen = stage_table(some[0].unionAll(some[1]), "toxic-chosen")
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text")).join(
        F.broadcast(chosen), "_id")  # at most LABELLED ids of each label

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = Counter(), Counter()
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(_WORD.findall(t.lower())).items():
                    n = min(n, IN_ONE_TEXT)
                    counts[y][""] += n
                    for gram in grams(word):
                        counts[y][gram] += n
            names = list(counts[0].keys() | counts[1].keys())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)],
                                                 ["gram", "c0", "c1"])

    found = (rows.select("_text", "_label")
             .mapInArrow(work, "gram string, c0 bigint, c1 bigint").groupBy("gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
             .filter(F.col("c0") + F.col("c1") >= SEEN).orderBy(F.desc(F.col("c0") + F.col("c1")), "gram").limit(GRAMS + 1)).toArrow()
    rows = list(zip(*(found.column(i).to_pylist() for i in range(3))))
    words = next(((a, b) for g, a, b in rows if g == ""), (0, 0))
    return [r for r in rows if r[0]], words


def _segments_of(docs: DataFrame, kept: list[str], text: str, odds: dict[str, float]) -> DataFrame:
    """Columns `kept` with the number of words and the scores of all segments."""
    shared = docs.sparkSession.sparkContext.broadcast(odds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in slices(batches):
            many, found = [], []
            for t in batch.column(len(kept)).to_pylist():
                words = _WORD.findall(t or "")
                many.append(len(words))
                found.append([s for _, _, s in segments(np.fromiter(map(scores.__getitem__, words), float, len(words)))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(many, pa.int64()),
                                              pa.array(found, pa.list_(pa.float64()))], [*kept, "words", "found"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept, text).mapInArrow(work, f"{kinds}, words bigint, found array<double>")


def _placed(judged: DataFrame, model: Model) -> DataFrame:
    """(_label, x): the place of each text on the logistic curve."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, found = (batch.column(i).to_pylist() for i in (1, 2))
            x = [on_curve(model.evidence(np.array(s), n)) for n, s in zip(words, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], ["_label", "x"])

    return judged.select("_label", "words", "found").mapInArrow(work, "_label int, x double")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from labelled rows; `labels` has doc_id and `label` (0 or 1, other values are passed over).

    Without rows of both labels the model has no words, and every text gets the rate of the label among what there is.
    """
    known = stage_table(_known(labels, label), "toxic-labels")
    counts, words = _counted(docs, known, doc_id, text)
    model = Model(log_odds(counts, words) if min(words) else {})
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).filter(fold(F.col("_id")) == CALIBRATION)
    # texts are not shuffled, only what is found in them
    judged = stage_table(_segments_of(rows, ["_id"], "_text", model.odds).join(known, "_id"), "toxic-segments")

    def binned(value: Column) -> Column:
        return (F.floor(value / BIN) * BIN + BIN / 2)

    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    law = (judged.filter((F.col("_label") == 0) & (F.col("words") > 0))
           .groupBy(F.floor(F.log2("words") * 4).alias("size"), F.when(best > 0, binned(best)).otherwise(0.0).alias("best"))
           .agg(F.count(F.lit(1)).alias("texts")).toArrow())
    cells = zip(*(law.column(i).to_numpy() for i in range(3)))
    model.rate, model.log_k = extreme_law((2 ** ((size + 0.5) / 4), x, many) for size, x, many in cells)

    curve = (_placed(judged, model).groupBy(binned(F.col("x")).alias("x"))
             .agg(F.count(F.lit(1)).alias("texts"), F.sum("_label").alias("toxic")).toArrow())
    model.offset, model.slope = logistic(zip(*(curve.column(i).to_numpy() for i in range(3))))
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence, passages) of every row: passages are its significant segments, in code points.

    Scores depend on the text alone. A null or empty text, or one without words, has no evidence and the lowest score.
    Repeated rows come out repeated, rows without an id as well; other columns of `docs` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        scores = Scores(fitted.odds)
        for batch in slices(batches):
            evidence, passages = [], []
            for t in batch.column(1).to_pylist():
                words = _WORD.findall(t or "")
                found = segments(np.fromiter(map(scores.__getitem__, words), float, len(words)))
                told = [(a, b, s) for a, b, s in found if fitted.significant(s, len(words))]
                places = [m.span() for m in _WORD.finditer(t)] if told else []
                passages.append([(places[a][0], places[b - 1][1], s) for a, b, s in told])
                evidence.append(fitted.evidence(np.array([s for _, _, s in found]), len(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(fitted.probability, evidence), pa.float64()),
                 pa.array(evidence, pa.float64()), pa.array(passages, _ARROW)], ["doc_id", "score", "evidence", "passages"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(work, f"doc_id {kind}, score double, evidence double, passages {TYPE}")
