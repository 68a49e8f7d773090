"""Toxic passages: the scan against brute force, the law on made-up scores, and held-out accuracy."""
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadrank.llm import common, queries, toxic_passages

from .test_operators import ODD, clash, prose

MIDDLE = "/root/testdata/sf0.01"


def plain_segments(scores):
    """Split off the best-scoring part (shortest, then leftmost) and go on to both sides of it."""
    best = max(((sum(scores[a:b]), a - b, -a, a, b) for a, b in itertools.combinations(range(len(scores) + 1), 2)), default=(0,))
    if best[0] <= 0:
        return []
    a, b = best[3:]
    return [*plain_segments(scores[:a]), (a, b, best[0]), *[(a2 + b, b2 + b, s) for a2, b2, s in plain_segments(scores[b:])]]


@pytest.mark.parametrize("seed", range(3))
def test_segments_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        scores = [rng.choice([-7, -3, -2, -1, 0.5, 1.25, 3, 6]) + rng.random() / 64 for _ in range(rng.randint(0, 18))]
        got = toxic_passages.segments(np.array(scores, float))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(scores)], scores
        assert all(math.isclose(s, sum(scores[a:b])) for a, b, s in got)


def test_segments_in_linear_time():
    scores = np.array([1.0, -0.5] * 100_000 + [1.0, -1.5] * 100_000)
    assert len(toxic_passages.segments(scores)) > 1


def test_log_odds_with_nested_priors():
    got = toxic_passages.log_odds([("abc", 10, 10), ("abcd", 0, 10), ("abcd ", 0, 0), ("abce ", 5, 0)], (1000, 1000))
    part = 0.5
    assert math.isclose(got["abc"], math.log((10 + 10 * part) / (10 + 10 * part)))
    assert math.isclose(got["abcd"], math.log(15 / 5)) and math.isclose(got["abcd "], got["abc"])  # nothing seen: its beginning's
    assert math.isclose(got["abce "], math.log(5 / 10))
    strong = toxic_passages.log_odds([("a" * k, 0, 10 ** 6) for k in range(3, 11)], (10 ** 7, 10 ** 7))
    assert all(map(math.isfinite, strong.values()))


def test_extreme_law_finds_the_rate():
    rng = np.random.default_rng(1)
    n = rng.choice([50, 400, 3000], 20_000)
    best = (np.log(0.1 * n) - np.log(-np.log(rng.random(len(n))))) / 1.7  # P(best < x) = exp(-K n exp(-rate x))
    rate, log_k = toxic_passages.extreme_law(zip(n, np.maximum(best, 0), np.ones(len(n))))
    assert abs(rate - 1.7) < 0.05 and abs(log_k - math.log(0.1)) < 0.15


def test_evidence_of_several_segments():
    model = toxic_passages.Model(rate=1.0, log_k=0.0)
    one, two = model.evidence(np.array([9.0]), 10), model.evidence(np.array([9.0, 9.0]), 10)
    x = 9 - math.log(10)
    assert math.isclose(one, x - math.log(2))
    assert math.isclose(two, max(one, 2 * x - math.log(2 * x) + math.log(2) - 2 * math.log(2))) and two > one
    assert model.evidence(np.array([9.0] + [0.1] * 500), 10) >= one
    assert model.evidence(np.array([]), 0) == 0 == model.evidence(np.array([0.5]), 10)


def test_logistic_curve():
    rng = np.random.default_rng(2)
    x = rng.normal(size=20_000)
    y = rng.random(len(x)) < 1 / (1 + np.exp(-(2 * x - 1)))
    offset, slope = toxic_passages.logistic(zip(x, np.ones(len(x)), y))
    assert abs(offset + 1) < 0.1 and abs(slope - 2) < 0.1
    assert toxic_passages.logistic([])[1] == 0


@pytest.fixture(scope="module")
def model(spark):
    return toxic_passages.fit(common.table(spark, MIDDLE, "documents"), common.table(spark, MIDDLE, "labels"))


def test_passages_of_a_text(spark, docs_of, model):
    plain = prose(3, 300)
    text = f"{plain} Ünd you idiot, clown and worthless moron, {plain}"
    got = toxic_passages.score(docs_of([(1, text), (2, plain)]), model).collect()
    by_id = {r.doc_id: r for r in got}
    told = " ".join(text[p.start:p.end] for p in by_id[1].passages)
    assert "idiot" in told and "moron" in told and len(told) < 100
    assert by_id[1].score > 0.5 > by_id[2].score and by_id[2].passages == []


def test_odd_tables(spark, docs_of, model):
    got = toxic_passages.score(clash(docs_of(ODD)), model).collect()
    assert len(got) == len(ODD) and sum(r.doc_id == 7 for r in got) == 2
    none = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(none) == 1 and min(r.score for r in got) == none.pop()
    assert toxic_passages.score(docs_of([]), model).collect() == []
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (9, 7), (3, None)], "doc_id long, toxic long")
    for docs, marks in ((docs_of([]), labels), (docs_of(ODD), labels.limit(0)), (clash(docs_of(ODD)), labels.filter("toxic = 0"))):
        flat = toxic_passages.fit(docs, marks)
        assert flat.odds == {} and 0 < flat.probability(0.0) < 1 and toxic_passages.score(docs_of(ODD), flat).count() == len(ODD)


def test_labels_of_the_held_out_fold_do_not_matter(spark, model):
    docs, labels = common.table(spark, MIDDLE, "documents"), common.table(spark, MIDDLE, "labels")
    turned = labels.withColumn("toxic", F.when(toxic_passages.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxic_passages.fit(docs, turned) == model


def test_query_as_registered(spark):
    rows = queries.op12_toxic_passages(spark, MIDDLE).collect()
    assert len(rows) == common.table(spark, MIDDLE, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    toxic = {r.doc_id: r.toxic for r in common.table(spark, MIDDLE, "labels").collect()}
    pairs = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    good, bad = ([s for s, y in pairs if y == label] for label in (1, 0))
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.9
