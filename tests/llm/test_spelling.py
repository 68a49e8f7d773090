"""Spelling variants against brute force."""
import collections
import random
import re
import zlib

import numpy as np
import pytest

from leadrank.llm import queries, spelling

from .test_operators import ODD, clash

SMALL = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain_forms(count, ratio=10):
    by_piece = collections.defaultdict(set)  # near words share a half
    for w in count:
        by_piece[w[:len(w) // 2 - 1]].add(w)
        by_piece[w[::-1][:len(w) // 2 - 1]].add(w)
    form, out = {}, {}
    for w, n in count.items():
        near = {x for k in (w[:len(w) // 2 - d] for d in (0, 1, 2)) for x in by_piece.get(k, ())}
        near |= {x for k in (w[::-1][:len(w) // 2 - d] for d in (0, 1, 2)) for x in by_piece.get(k, ())}
        near = [x for x in near if one_edit(w, x)]
        best = min(near, key=lambda x: (-count[x], x), default=None)
        if best and count[best] >= ratio * n:
            form[w] = best
        out[w] = (n, len(near), form.get(w), count[form[w]] if w in form else None)
    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (*v, root(w)) for w, v in out.items()}


def found(frame):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


@pytest.mark.parametrize("blocks, bits", [(spelling.MAX_BLOCKS, spelling.BITS_PER_WORD), (8, 2)])
def test_forms_equal_brute_force(spark, monkeypatch, blocks, bits):
    monkeypatch.setattr(spelling, "MAX_BLOCKS", blocks)  # many passes, and many false positives
    monkeypatch.setattr(spelling, "BITS_PER_WORD", bits)
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(160)}
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "aaaa", "aaaaa", "Ü" + "a" * 6, "ÿ" + "a" * 6}
    count = {w: rng.choice([1, 2, 10, 30, 100, 1000]) for w in sorted(words)}
    frame = spark.createDataFrame(list(count.items()), "word string, n bigint")
    assert found(spelling.forms(frame)) == plain_forms(count)


def test_edits_meet_each_pair_once():
    words = ["kitten", "sitten", "kiten", "kittens", "mitten", "kkitten"]
    _, _, codes = next(x for x in spelling._by_length(words) if x[0] == 6)
    everything = spelling.Shard(1, 0, 1)
    everything.bits[:] = ~np.uint64(0)
    letters = np.array([ord("k"), ord("s")], np.uint32)
    made = [("kitten" if letter < 0 else None, k, letter) for i, k, letter in spelling.edits(codes[:1], letters, {6: everything, 5: everything})]
    assert sorted((k, chr(letter)) for _, k, letter in made if letter > 0) == sorted(
        [(0, "s"), (1, "k"), (1, "s"), (4, "k"), (4, "s"), (5, "s")])
    assert sorted(k for _, k, letter in made if letter < 0) == [0, 1, 2, 4, 5]  # one t only


def test_odd_tables(spark, docs_of):
    docs = clash(docs_of([*ODD, (9, "Ärgerlich ärgerlich ARGERLICH argerlicH argerlich"), (None, "ÄrGERlich")]))
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got["argerlich"] == 3 and got["Ärgerlich"] == 2 and "ärgerlich" not in got
    assert spelling.forms(spelling.vocabulary(docs.limit(0))).collect() == []
    assert spelling.forms(spelling.vocabulary(docs_of([(None, None)]))).columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_query_as_registered(spark):
    count = collections.Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            k = h % len(run)
            word = run[:k] + run[k + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                count[word] += 1
    want = plain_forms({w: n for w, n in count.items() if n >= 2})
    assert any(v[4] != w for w, v in want.items())
    assert found(queries.op11_spelling(spark, SMALL)) == want
