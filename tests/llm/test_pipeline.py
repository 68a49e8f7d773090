"""The corpus pipeline against plain versions of its stages, and its stages on odd tables."""
import collections
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadrank.llm import common, decontaminate, packing, quality_votes, secret_scan, simhash, spans, tokens

from .test_operators import ODD, clash, plain_components, plain_distance, plain_simhash

SMALL = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    docs = common.table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    model = quality_votes.fit(docs, common.table(spark, SMALL, "labels"))
    kept = {i: t for i, t in texts.items() if model.scores([t.encode()], quality_votes.NEIGHBOURS)[0] >= quality_votes.THRESHOLD}
    ids = sorted(kept)
    group = plain_components([plain_simhash(kept[i]) for i in ids], simhash.RADIUS)
    kept = {i: kept[i] for place, i in enumerate(ids) if group[place] == place}
    items = {r.item_id: decontaminate.normalise(r.text.encode()) for r in common.table(spark, SMALL, "benchmark").collect()}
    index = decontaminate.Index.of(list(items.items()), decontaminate.Q, decontaminate.EDIT_RATE, decontaminate.WINDOW)
    clean = {}
    for i, t in kept.items():
        plain = decontaminate.normalise(t.encode())
        hits = list(index.hits(plain, decontaminate.Q))
        if any(item in plain for item in items.values()):
            assert hits
        for w, start, end, edits in hits[:1]:  # what is found is near, by plain edit distance
            around = plain[max(0, start - 20):end + 20]
            assert plain_distance(index.texts[w], around) <= decontaminate.edit_budget(len(index.texts[w]))
        if not hits:
            clean[i] = t
    assert 0 < len(clean) < len(kept) < len(texts)
    frame = spark.createDataFrame(list(clean.items()), "doc_id bigint, text string")
    ratio = secret_scan.fit(frame)
    clean = {i: spans.redact(t, secret_scan.find(t, ratio), secret_scan.MASK) for i, t in clean.items()}
    want = collections.Counter()
    for i, t in clean.items():
        found = tokens.encode([t.encode()])[0]
        for n, (s, length) in enumerate(packing.cuts(len(found), packing.CAPACITY)):
            want[i, n, s, length, zlib.crc32(found[s:s + length].tobytes())] += 1
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == want
    fill = collections.Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_tables(spark, docs_of, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (clash(docs_of(ODD)), clash(docs_of([])), docs_of([(None, None)])):
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            if number != 0:  # nothing here is a copy but doc 7, holds a passage or a secret
                ids = {r.doc_id for r in docs.collect()}
                assert ids - {r.doc_id for r in rows} <= {2, 3, 8}, name
        else:
            assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}


def test_secrets_change_the_text_and_its_length(spark, docs_of):
    docs = docs_of([(1, 'a token = "0123456789abcdef0123" b'), (2, None), (3, "plain")])
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secret_scans(spark, docs, SMALL).collect()}
    assert got == {1: ('a [SECRET]" b', 13), 2: (None, None), 3: ("plain", 5)}
    assert docs.filter(F.col("text").isNull()).count() == 1
