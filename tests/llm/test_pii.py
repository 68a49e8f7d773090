"""Personal data: base kinds against the contract's patterns, trees and calibration against plain versions, recall of what is rubbed out."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadrank.llm import common, pii, queries, spans

MIDDLE, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def plain_base(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_kinds_equal_their_patterns():
    rng = random.Random(6)
    bits = ["1", "23", "255", "256", ".", " ", "-", "+", "(", ")", "@", "a", "b.c", "é", "4539 1488 0343 6467", "4539148803436467", "0", "00", "1.2.3.4", "+1 617", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))
        assert sorted(s[:3] for s in pii.base_spans(text)) == plain_base(text), text


@pytest.mark.parametrize("text, span", [
    ("contact jane at example.com now", "jane at example.com"), ("Jane.Doe At Example Dot Com", "Jane.Doe At Example Dot Com"),
    ("write a [at] b (dot) co", "a [at] b (dot) co"), ("host 2001:db8::1f:2 up", "2001:db8::1f:2"), ("see fe80:0:0:0:1:2:3:4.", "fe80:0:0:0:1:2:3:4"),
    ("from 10[.]0[.]0[.]1 again", "10[.]0[.]0[.]1"), ("call (617) 555-0142 or", "(617) 555-0142")])
def test_generators_are_open(text, span):
    assert any(text[a:b].strip() == span or span in text[a:b] for a, b in pii.candidates(text)), [text[a:b] for a, b in pii.candidates(text)]


def test_every_form_that_is_learnt_is_a_candidate():
    for kind, span in enumerate(["a.b@mail.example.com", "10.20.30.40", "4539 1488 0343 6467", "+1 (617) 555-0142"]):
        for form in pii.rubbed_out(span, kind):
            text = f"see {form} there"
            assert any(form in text[a:b] for a, b in pii.candidates(text)), form


def test_a_tree_equals_the_plain_best_splits():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 6, (400, 3))
    gradient, hessian = rng.normal(size=400) + (bins[:, 1] > 2), np.full(400, 0.25)
    feature, cut, value = pii._grow(bins, gradient, hessian)

    def gain(rows, f, c):
        left, right = [r for r in rows if bins[r, f] <= c], [r for r in rows if bins[r, f] > c]
        if min(len(left), len(right)) < pii.LEAST_LEAF:
            return 0.0
        part = lambda rs: gradient[rs].sum() ** 2 / (hessian[rs].sum() + 1)
        return part(left) + part(right) - part(list(rows))

    def check(node, rows):
        if node >= 2 ** pii.DEPTH - 1:
            want = pii.RATE * gradient[rows].sum() / (hessian[rows].sum() + 1)
            assert value[node - (2 ** pii.DEPTH - 1)] == pytest.approx(want)
            return
        best = max(gain(rows, f, c) for f in range(3) for c in range(5))
        assert gain(rows, feature[node], cut[node]) == pytest.approx(max(best, 0)) or cut[node] == pii.BINS
        check(2 * node + 1, [r for r in rows if bins[r, feature[node]] <= cut[node]])
        check(2 * node + 2, [r for r in rows if bins[r, feature[node]] > cut[node]])

    check(0, list(range(400)))


def test_calibration_is_the_best_rising_fit():
    rng = np.random.default_rng(3)
    score = rng.integers(0, 8, 60).astype(float)
    y = (rng.random(60) < score / 10).astype(float)
    edges, share = pii.calibrate(score, y)
    fitted = share[np.searchsorted(edges, score, side="right") - 1]
    assert (np.diff(share) > 0).all() and (np.diff(edges) > 0).all()
    levels = np.unique(score)
    # the minimax formula of isotonic regression
    mean = lambda a, b: y[(score >= a) & (score <= b)].mean()
    want = [max(min(mean(a, b) for b in levels[levels >= v]) for a in levels[levels <= v]) for v in score]
    assert fitted == pytest.approx(want)


def test_all_documents_are_learnt_from(spark, monkeypatch):
    """Share, cuts and first tree of many candidates are those of all of them."""
    monkeypatch.setattr(pii, "ROUNDS", 1)
    rng = random.Random(4)
    pieces = lambda: rng.choice([f"+1 617 555 {rng.randint(1000, 9999)}", f"sum {rng.randint(10 ** 6, 10 ** 9)} of", "a@b.cc and"])
    texts = [(n, " ".join(pieces() for _ in range(40))) for n in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = pii.fit(docs)
    apart = dict(docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).collect())
    rows = [(apart[n], label, x) for n, t in texts for label, x in pii.labelled(t)]
    assert len(rows) > 40_000
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows], float)
    for f, cuts in enumerate(model.cuts):
        assert cuts == pytest.approx(np.unique(np.quantile(x[:, f], np.linspace(0, 1, pii.BINS + 1)[1:-1])))
    learnt = ~np.array([r[0] for r in rows])
    share = y[learnt].mean()
    assert model.start == pytest.approx(np.log(share / (1 - share)))
    feature, cut, value = pii._grow(model.binned(x[learnt]), y[learnt] - share, np.full(learnt.sum(), share * (1 - share)))
    assert (model.trees[0][0] == feature).all() and (model.trees[0][1] == cut).all()
    assert model.trees[0][2] == pytest.approx(value, abs=1e-4)


def test_rubbed_out_data_of_held_out_documents(spark):
    """Learnt on one half of the documents; the marks of the other half's base spans are rubbed out and looked for."""
    docs = common.table(spark, "/root/testdata/sf0.1", "documents").filter(F.col("text").rlike("[0-9@]"))
    model = pii.fit(docs.filter("doc_id % 2 = 0"))
    found = total = 0
    for r in docs.filter("doc_id % 2 = 1").select("text").toLocalIterator():
        for start, kind, end, _ in pii.base_spans(r.text)[:3]:
            form = pii.rubbed_out(r.text[start:end], kind)[0]
            text = r.text[max(0, start - 60):start] + form + r.text[end:end + 60]
            at = min(start, 60)
            if any(s[:3:2] == (at, at + len(form)) for s in pii.base_spans(text)):
                continue  # still a base span
            total += 1
            found += any(s < at + len(form) and e > at for s, _, e, _ in pii.find(text, model))
    assert total > 50 and found / total > 0.8, (found, total)


def test_query_as_registered(spark):
    import hashlib
    got = {r.doc_id: r for r in queries.op10_pii(spark, SMALL).collect()}
    for r in common.table(spark, SMALL, "documents").collect():
        want = plain_base(r.text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        row = got[r.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for _, k, _ in want) for x in range(4)]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
