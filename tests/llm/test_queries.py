"""The queries without SQL as they are registered, over whole tables, against plain versions of their contracts."""
import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadrank.llm import common, packing, quality_votes, queries, simhash

from .test_operators import plain_components, plain_repeats, plain_simhash

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in common.table(spark, SMALL, "documents").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    """The plain library call on each text, and the id that ends it."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}


def test_op2(spark, ids):
    want, start = {}, 0
    for i in sorted(ids):
        want[i] = (start, len(ids[i]), zlib.crc32(ids[i].tobytes()))
        start += len(ids[i])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op2_token_orc(spark, SMALL).collect()} == want


def test_op3(spark, texts):
    order = sorted(texts)
    fps = [plain_simhash(texts[i]) for i in order]
    group = plain_components(fps, simhash.RADIUS)
    want = {i: (f"{fp:016x}", order[g]) for i, fp, g in zip(order, fps, group)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash(spark, SMALL).collect()} == want


def test_op5(spark, texts):
    order = sorted(texts)
    want = {i: (n, removed, runs, hashlib.sha256(kept).hexdigest())
            for i, (n, removed, runs, kept) in zip(order, plain_repeats([texts[i].encode() for i in order], 200))}
    assert {r.doc_id: tuple(r[1:]) for r in queries.op5_suffix_dedup(spark, SMALL).collect()} == want


def test_op6(spark, texts):
    """Every document that holds a benchmark item letter for letter is named with it."""
    items = {r.item_id: " ".join(r.text.split()).lower() for r in common.table(spark, SMALL, "benchmark").collect()}
    plain = {i: " ".join(t.split()).lower() for i, t in texts.items()}
    holds = {i for i, t in plain.items() if any(x and x in t for x in items.values())}
    found = {r.doc_id for r in queries.op6_decontaminate(spark, SMALL).collect()}
    assert holds and holds <= found and len(found) < len(texts) // 2


def test_op8(spark, texts):
    rows = queries.op8_quality_votes(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    model = quality_votes.fit(common.table(spark, SMALL, "documents"), common.table(spark, SMALL, "labels"))
    score = dict(zip(texts, model.scores([t.encode() for t in texts.values()], quality_votes.NEIGHBOURS)))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)
        assert r.score == pytest.approx(float(score[r.doc_id]), abs=1e-6)


def test_op9(spark, ids):
    rows = queries.op9_packing(spark, SMALL).collect()
    want = {(i, n, s, length, zlib.crc32(x[s:s + length].tobytes())) for i, x in ids.items()
            for n, (s, length) in enumerate(packing.cuts(len(x), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 2048
    total = sum(len(x) for x in ids.values())
    assert len(bins) <= -(-total // 2048) + 1
