"""Periodic runs against brute force."""
import hashlib
import random
import zlib

import pytest

from leadrank.llm import periodic_runs, queries

from .test_operators import ODD, clash

SMALL = "/root/testdata/sf0.001"


def plain_runs(w, least=12):
    out = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                s = i
                while i + q < len(w) and w[i] == w[i + q]:
                    i += 1
                run = w[s:i + q]
                if len(run) >= max(least, 2 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.add((s, len(run), q))
            i += 1
    return sorted(out)


def plain_collapsed(w, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in dropped)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n, letters = rng.randint(0, 70), rng.choice([1, 2, 3, 5, 30])
        w = [b"%d" % rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 12)
            w[a:] = [w[min(n - 1, a + i % p)] for i in range(n - a)]
        least = rng.choice([1, 2, 4, 12, 13])
        assert periodic_runs.runs_of(w, least) == plain_runs(w, least), w
        assert periodic_runs.find(w, least) == plain_runs(w, least), w


def test_nested_runs_of_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic_runs.find(b) == plain_runs(b)


def test_equal_hashes_do_no_harm(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_FACTOR", 0)  # a window is told by its last word only
    rng = random.Random(8)
    w = [b"%d" % rng.randrange(6) for _ in range(60)] * 3
    assert periodic_runs.find(w) == plain_runs(w)


def test_odd_tables(spark, docs_of):
    got = periodic_runs.scan(clash(docs_of([*ODD, (9, "a b " * 50_000 + "c")]))).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(ODD) + 1 and sum(r.doc_id == 7 for r in got) == 2
    assert [tuple(x) for x in by_id[9].runs] == [(0, 100_000, 2)] and by_id[9].collapsed == "a b c"
    assert by_id[1].runs == by_id[2].runs == by_id[3].runs == [] and by_id[3].collapsed == ""
    assert by_id[None].collapsed == "no id"
    assert periodic_runs.digest(periodic_runs.scan(docs_of([]))).collect() == []


def test_query_as_registered(spark):
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        w, h = (r.text or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 3000:
            continue  # too slow for brute force
        runs = plain_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want[r.doc_id] = (len(runs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
                          hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(w, runs)).hexdigest())
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    assert {i: got[i] for i in want} == want and sum(v[0] > 0 for v in want.values()) > 5
