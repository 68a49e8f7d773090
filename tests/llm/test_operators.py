"""Each operator against brute force, and what it makes of nulls, empty and long texts, ties, repeats and empty tables."""
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from leadrank.llm import (common, decontaminate, host_quality, packing, pii, quality_votes, secret_scan, simhash,
                          spans, suffix_dedup, token_orc, tokens, url_filter)

WORDS = "the of and to in that was with for river stone amber silent copper meadow lantern winter harbor velvet".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


ODD = [(None, "no id"), (1, None), (2, ""), (3, "   \n\t"), (4, "x"), (5, "naïve Ünïcode 漢字 🙂"), (6, prose(1, 20_000)), (7, prose(2, 90)),
       (7, prose(2, 90)), (8, prose(2, 90))]


def clash(df):
    """The same documents with further columns named like those that operators use."""
    names = ["key", "row", "fp", "root", "spans", "host", "part", "ids", "start", "h", "at", "best", "label", "_id", "_salt", "_row",
             "_hot", "n_tokens", "length", "score"]
    return df.select("*", *[F.lit(1).alias(n) for n in names])


@pytest.fixture(scope="module")
def odd(docs_of):
    return clash(docs_of(ODD))


# 1 ------------------------------------------------------------------------------------------------------------------

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def judged(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(len(r), r, v) for r, v in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
            if ("." + host).endswith("." + h) and path.startswith(p)]
    return (host, path, *((max(fits)[1:]) if fits else (None, "allow")))


def test_urls_against_every_rule(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/", "http://net", "http://net?x/", "https://a.Example.NET/en/1#t", "https://example.net/fr/",
            "x://notexample.net/en/", "http://example.com/de/x", "http://example.com/de", "http://org/fr/", "http://a.b.org/fr/é?",
            "http://a://b/", "http://" + "a." * 3000 + "net/" + "x" * 5000] + ["http://hot.example.com/de/1"] * 60
    pages = clash(spark.createDataFrame(list(enumerate(urls)) + [(None, urls[4])], "page_id bigint, url string"))
    got = url_filter.judge(pages, spark.createDataFrame(RULES, "url string, verdict string")).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        url = urls[4] if r.page_id is None else urls[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == judged(url), url


def test_url_lists(spark):
    pages = spark.createDataFrame([(1, "http://s7.com/a"), (2, "http://s999.com/b"), (3, "http://s8.com/")], "page_id bigint, url string")
    listed = spark.range(900).select(F.format_string("http://S%d.com", "id").alias("url"), F.lit("block").alias("verdict"))
    more = spark.createDataFrame([(None, "block"), ("", "block"), ("s8.com", "allow")], "url string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, listed.unionByName(more), max_blocks=2).collect()}
    assert got == {1: ("s7.com", "block"), 2: (None, "allow"), 3: ("s8.com", "block")}
    none = url_filter.judge(pages, more.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in none] == [(None, "allow")] * 3
    assert url_filter.judge(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = url_filter.bloom_blocks(keys, 125)

    def passed(df):
        df = df.withColumn("block", url_filter._block(F.col("key"), 125)).join(blocks, "block")
        for j, m in enumerate(url_filter._masks(F.col("key"))):
            df = df.filter(F.col(f"w{j}").bitwiseAND(m) == m)
        return df.count()

    assert passed(keys) == 2000
    assert passed(spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))) < 400


# 2 ------------------------------------------------------------------------------------------------------------------

def test_token_files_round_trip(spark, odd, tmp_path):
    path = str(tmp_path / "tokens")
    token_orc.write(odd, path)
    got = token_orc.read(spark, path).collect()
    tok = tokens._tokenizer(tokens.VOCABULARY)
    want = collections.Counter((i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in ODD)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    plan = token_orc.read(spark, path).filter("doc_id = 5")
    assert "EqualTo(doc_id,5)" in plan._jdf.queryExecution().toString() and plan.count() == 1
    token_orc.write(odd.limit(0), path + "-none")
    assert token_orc.read(spark, path + "-none").count() == 0


def test_encoding_by_words_equals_encoding_at_once(monkeypatch):
    rng = random.Random(11)
    tok = tokens._tokenizer(tokens.VOCABULARY)
    bits = [" ", "  ", "\n", "\n ", " \n", "\t", "\u00a0", "\u3000", "\x1f", "don't", "it's", "word", "Wörter,", "123", "...", "<|endoftext|>", "漢字", "🙂", "Ċ", "'", "a", "_b", "ab,", "ab,,", "é.", "1.", "a1!", "Äß?", "a.\nB", "\nB,"]
    texts = ["".join(rng.choice(bits + [" "] * 12) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [" ".join(rng.choice(bits[9:]) for _ in range(40)) for _ in range(500)] + ["x" * 5000 + ", " + "y.\n" * 3000 + "z é" + "ß" * 101] + ["", " ", "  ", " a", "a ", "\n"]
    got = tokens.encode([t.encode() for t in texts])
    assert len(got) == len(texts)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 500)
    monkeypatch.setattr(tokens, "WORDS_KEPT", 50)  # generations change often
    again = tokens.encode(pa.array([*texts, None]).slice(1))
    assert [x.tolist() for x in again] == [*[x.tolist() for x in got[1:]], [0]]
    for text, ids in zip(texts, got):
        assert ids.tolist() == [*tok.encode(text, add_special_tokens=False).ids, 0], repr(text)


# 3 ------------------------------------------------------------------------------------------------------------------

def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    group = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= radius and group[a] != group[b]:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    return group


def test_fingerprints(odd):
    got = sorted((r.doc_id or -1, r.fp % 2 ** 64) for r in simhash.fingerprints(odd).collect())
    assert got == sorted((i or -1, plain_simhash(t)) for i, t in ODD)


@pytest.mark.parametrize("radius,bits,at_once", [(4, 8, 2_000_000), (4, 12, 500), (2, 10, 2_000_000)])
def test_ball_links_give_the_components_of_all_pairs(spark, monkeypatch, radius, bits, at_once):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(120)}
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    half, found = radius // 2, []
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", at_once)
    arr = np.array(fps, np.uint64)
    for prefix in {(f >> (64 - bits)) ^ int(m) for f in fps for m in simhash._masks(bits, half)}:
        near = arr[np.bitwise_count((arr >> np.uint64(64 - bits)) ^ np.uint64(prefix)) <= half]
        for a, b in simhash._meet(near, prefix, bits, half):
            found += list(zip(a.tolist(), b.tolist()))
    at = {f: i for i, f in enumerate(fps)}
    a, b = (np.array([at[x[i]] for x in found], np.int64) for i in (0, 1))
    assert simhash._forest(a, b, len(fps)).tolist() == plain_components(fps, radius)
    if at_once > 500:
        df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
        links = [(r.src % 2 ** 64, r.dst % 2 ** 64) for r in simhash.ball_links(df, radius, bits).collect()]
        a, b = (np.array([at[x[i]] for x in links], np.int64) for i in (0, 1))
        assert simhash._forest(a, b, len(fps)).tolist() == plain_components(fps, radius)


def test_near_duplicates(odd, docs_of):
    got = sorted(((r.doc_id or -1), r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect())
    fps = [plain_simhash(t) for _, t in ODD]
    group = plain_components(fps, 4)
    first = {g: min(i for (i, _), h in zip(ODD, group) if h == g and i is not None) if any(
        i is not None for (i, _), h in zip(ODD, group) if h == g) else None for g in group}
    assert got == sorted((i or -1, f"{f:016x}", first[g]) for (i, _), f, g in zip(ODD, fps, group))
    assert simhash.near_duplicates(docs_of([])).count() == 0


# 4 ------------------------------------------------------------------------------------------------------------------

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in collections.Counter(grams).items() if n > 1}
    covered = {i + d for i, g in enumerate(grams) if g in often for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures():
    for text in [*(t for _, t in ODD), "a b c a b c a", "a\na\n\n\n b\n b\na #*$", "a a a a", "\x1f\x85 x\u00a0y", "x\r\nx\r\n"]:
        assert host_quality.measures((text or "").encode()) == plain_measures(text), text and text[:40]


def test_host_verdicts(docs_of, spark):
    good, bad = prose(5, 80), "too short"
    rows = [(i, t, "en", h, 0) for i, (t, h) in enumerate([(good, "a")] * 40 + [(bad, "b")] * 30 + [(good, "b")] + [(bad, "c")] + [(good, None)] * 3 + [(bad, None)])]
    docs = spark.createDataFrame(rows + rows[-1:], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = collections.Counter((rows[r.doc_id][3], r.base_failed, r.kept) for r in host_quality.judge(clash(docs).drop("host")).collect())
    assert got == {("a", False, True): 40, ("b", True, False): 30, ("b", False, False): 1, ("c", True, False): 1,
                   (None, False, True): 3, (None, True, False): 2}
    rates = {r.host: r for r in host_quality.host_verdicts(host_quality.base_measures(docs)).collect()}
    assert 0 < rates["a"].rate < rates["c"].rate < 1 and not rates["a"].host_rejected
    assert host_quality.judge(docs.limit(0)).count() == 0


# 5 ------------------------------------------------------------------------------------------------------------------

def plain_repeats(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = [True] * length
        runs = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(t), sum(hit), runs, bytes(c for c, h in zip(t, hit) if not h)))
    return out


@pytest.mark.parametrize("length,gram,at_once", [(200, 32, 40_000), (200, 32, 5), (60, 8, 40_000), (40, 8, 3)])
def test_repeated_strings_go(docs_of, monkeypatch, length, gram, at_once):
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_AT_ONCE", at_once)
    rng = random.Random(length)
    passage = prose(9, 60)
    texts = [None, "", "x", passage, passage[:length - 1], passage[:length], prose(3, 50) + passage, passage + prose(4, 50), "ab" * 300,
             "z" * (length + 1), "z" * length, prose(1, 3000), prose(1, 3000)[500:2500], passage[3:] + "é🙂" + passage[:250]]
    for _ in range(25):  # small changes inside copies
        t = list(prose(20, 120))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice("abc é")
        texts.append("".join(t))
    docs = clash(docs_of(list(enumerate(texts))))
    got = sorted(suffix_dedup.remove_repeats(docs, length=length, gram=gram).collect())
    want = plain_repeats([(t or "").encode() for t in texts], length)
    assert [(*r[1:4], bytes(r.kept)) for r in got] == want


def test_no_text_to_compare(docs_of):
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0
    assert [r.n_removed for r in suffix_dedup.remove_repeats(docs_of([(None, "a" * 150)])).collect()] == [0]


# 6 ------------------------------------------------------------------------------------------------------------------

def plain_distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for a in pattern:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(text, n, rng):
    t = list(text)
    for _ in range(n):
        i = rng.randrange(len(t))
        rng.choice([lambda: t.pop(i), lambda: t.insert(i, rng.choice("qxz")), lambda: t.__setitem__(i, rng.choice("qxz"))])()
    return "".join(t)


def test_contamination_equals_edit_distance(spark, docs_of):
    rng = random.Random(3)
    items = [(n, prose(100 + n, 12 + 7 * (n % 4))) for n in range(12)] + [(50, None), (51, ""), (52, "tiny")]
    texts = [None, "", "word", prose(7, 400)]
    for n, (_, item) in enumerate(items[:12]):
        for edits in (0, 4, 9, 15, 25):
            texts.append(prose(n, 15) + " " + edited(item, edits, rng) + " " + prose(n + 1, 15))
    docs = clash(docs_of(list(enumerate(texts))))
    bench = clash(spark.createDataFrame(items + items[:1], "item_id bigint, text string"))
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=500).collect())
    want = collections.Counter()
    for d, text in enumerate(texts):
        text = decontaminate.normalise((text or "").encode())
        for n, item in items + items[:1]:
            item = decontaminate.normalise((item or "").encode())
            if len(item) >= decontaminate.Q and any(plain_distance(item[lo:hi], text) <= decontaminate.edit_budget(hi - lo)
                                                    for lo, hi in decontaminate.windows(len(item))):
                want[d, n] += 1
    assert got == want and len(want) >= 24
    kept = [r.doc_id for r in decontaminate.clean(docs, bench, block_bytes=500).collect()]
    assert kept == [d for d in range(len(texts)) if all((d, n) not in want for n, _ in items)]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean(docs.limit(0), bench).count() == 0


# 7, 10 --------------------------------------------------------------------------------------------------------------

def test_base_secrets():
    key = "AKIA" + "B" * 16
    text = f"é token = \"abc123\" PassWord:x api_key='{'f' * 24}' {key} AKIASHORT {'0a' * 12} ſecret=abcdefg"
    got = [(text[s:e], k) for s, k, e, *_ in sorted(secret_scan.base_spans(text))]
    assert got == [('token = "abc123', 0), (f"api_key='{'f' * 24}", 0), ("f" * 24, 2), (key, 1), ("0a" * 12, 2)]


def test_random_tokens_and_identifiers(odd, docs_of):
    texts = [(n, prose(n, 200) + f' token = "{hashlib.sha1(str(n).encode()).hexdigest()}"') for n in range(80)]
    ratio = secret_scan.fit(docs_of(texts))
    rng = random.Random(1)
    keys = ["".join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(32)) for _ in range(40)]
    assert sum(len(secret_scan.find(f"see {k} there", ratio)) for k in keys) >= 38
    for plain in ["meadow_lantern_silent_river_stone", "silentMeadowLanternOfTheWinterHarbor", "thethethethethethethethethe"]:
        assert not secret_scan.find(plain, ratio)
    got = {r.doc_id: r.spans for r in secret_scan.scan(odd, ratio).collect()}
    assert len(got) == 9 and not any(got.values())
    assert secret_scan.scan(docs_of([]), secret_scan.fit(docs_of([]))).count() == 0
    cleaned = {r.doc_id: r.text for r in secret_scan.redacted(docs_of(texts[:3] + [(9, None)]), ratio).collect()}
    assert cleaned[9] is None and all(cleaned[n].endswith(" " + secret_scan.MASK + '"') for n in range(3))


def test_base_personal_data():
    text = "é a.b@mail.example.com x@y 1.2.3.4 999.1.1.1 or 4539 1488 0343 6467 or 4539148803436468 or +1 (017) 555-7713, +12 3"
    got = [(text[s:e], k) for s, k, e, _ in sorted(pii.base_spans(text))]
    assert got == [("a.b@mail.example.com", 0), ("1.2.3.4", 1), ("4539 1488 0343 6467", 2), ("+1 (017) 555-7713", 3)]
    assert [pii.luhn(x) for x in ("4539148803436467", "4539148803436468")] == [True, False]
    assert not pii.base_spans("9" * 5000 + ".1.1.1")


def test_emails_equal_their_pattern():
    rng = random.Random(3)
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        text = "".join(rng.choice("ab.-_@@ é+") for _ in range(rng.randint(0, 30)))
        assert list(pii._emails(text)) == [m.span() for m in pattern.finditer(text)], text


@pytest.mark.parametrize("text", ["a" * 300_000 + " (x@", "1" * 300_000 + ".", "1." * 100_000, "a@" * 100_000, "+1" + " " * 300_000,
                                  "password" + " " * 300_000, "at dot " * 40_000, "f" * 300_000])
def test_long_runs_take_linear_time(text):
    model = pii.Trees([np.zeros(0)] * len(pii.features("", "", "")), [], 0.0, np.zeros(0), np.zeros(0))
    pii.find(text, model)
    secret_scan.find(text, secret_scan.Ratio.of(np.zeros((68, 67)), np.zeros((68, 67))))


def test_trees_accept_what_is_like_personal_data(odd, docs_of):
    rng = random.Random(2)
    texts = []
    for n in range(400):
        phone = f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        texts.append((n, f"{prose(n, 20)} {phone} {prose(n + 1, 9)} year {rng.randint(1000, 2999)} to {rng.randint(1000, 2999)} "
                         f"sum {rng.randint(10 ** 6, 10 ** 8)} and a{n}@mail.example.com {prose(n + 2, 5)} {rng.randint(1, 99999)} {rng.randint(1, 999999999)}"))
    model = pii.fit(docs_of(texts))
    assert np.isfinite(model.threshold)
    found = pii.find("please call (617) 555-0142 or write", model)
    assert [(s, e) for s, _, e, base in found if not base] == [(12, 26)]
    clean = [pii.find(f"in {y} we sold {y * 7919 % 10 ** 7} of them", model) for y in range(1900, 2000)]
    assert sum(map(bool, clean)) <= 3
    got = {r.doc_id: r.spans for r in pii.scan(odd, model).collect()}
    assert len(got) == 9 and not any(got.values())
    empty = pii.fit(docs_of([]))
    assert pii.scan(docs_of([(1, "a@b.cc")]), empty).first().spans[0].kind == "email" and not pii.find("1 at 2 dot 3", empty)


def test_digest(docs_of):
    docs = docs_of([(1, "mail a@b.cc now"), (2, None)])
    rows = {r.doc_id: r for r in spans.digest(pii.scan(docs, pii.fit(docs)), pii.KINDS).collect()}
    assert rows[1].n_email == 1 and rows[1].spans == "email:5:11" and rows[1].base_sha256 == hashlib.sha256(b"email:5:11").hexdigest()
    assert rows[2].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_redaction_joins_overlapping_spans():
    assert spans.redact("abcdefghij", [(1, 0, 4, True), (3, 1, 5, True), (8, 0, 10, True)], "#") == "a#fgh#"


# 8 ------------------------------------------------------------------------------------------------------------------

def test_votes_on_held_out_documents(spark, odd):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    labels = common.table(spark, "/root/testdata/sf0.01", "labels")
    model = quality_votes.fit(docs, labels)
    got = (quality_votes.score(docs, model).join(labels, "doc_id").filter(quality_votes.held_out(F.col("doc_id")))
           .select("score", "quality").collect())
    right = sum((r.score >= quality_votes.THRESHOLD) == (r.quality == 1) for r in got)
    assert len(got) > 50 and right >= 0.95 * len(got)
    scores = {r.doc_id: r.score for r in quality_votes.score(odd, model).collect()}
    assert len(scores) == 9 and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] == scores[2] == scores[3] == pytest.approx(model.base_rate)
    for twisted in (labels.withColumn("quality", F.lit(None).cast("int")), labels.limit(0)):
        none = quality_votes.fit(docs, twisted)
        assert {r.score for r in quality_votes.score(odd, none).collect()} == {0.5}
    assert quality_votes.score(odd.limit(0), model).count() == 0


def test_votes_equal_plain_cosines(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    model = quality_votes.fit(docs, common.table(spark, "/root/testdata/sf0.001", "labels"), per_label=40, dimensions=16)
    texts = [r.text.encode() for r in docs.limit(30).collect()]
    for text, score in zip(texts, model.scores(texts, 5)):
        x = model.embed(text)
        near = sorted((float(np.dot(x, v)), float(y)) for v, y in zip(model.vectors, model.labels))[-5:]
        weights = [max(c, 0) ** quality_votes.SHARPNESS for c, _ in near]
        want = (sum(w * y for w, (_, y) in zip(weights, near)) + quality_votes.PRIOR_WEIGHT * model.base_rate) / (sum(weights) + quality_votes.PRIOR_WEIGHT)
        assert score == pytest.approx(want, abs=0.02)


# 9 ------------------------------------------------------------------------------------------------------------------

def test_packing(odd, docs_of):
    rows = packing.pack(odd, capacity=64).collect()
    tok = tokens._tokenizer(tokens.VOCABULARY)
    want = collections.Counter()
    for i, t in ODD:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n, (s, length) in enumerate(packing.cuts(len(ids), 64)):
            want[i, n, s, length, zlib.crc32(ids[s:s + length].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows) == want
    at = collections.defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(docs_of([])).count() == 0


def test_exchange_between_partitions(spark):
    rng = random.Random(4)
    lengths = [rng.choice([30, 34, 50, 63, 64]) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(lengths)), "key bigint, length bigint")
    got = packing.plan(df, capacity=64, pieces_at_once=40).collect()
    assert sorted(r.key for r in got) == list(range(900))
    fill = collections.Counter()
    for r in got:
        fill[r.sequence_id] += lengths[r.key]
    assert max(fill.values()) <= 64
    assert len(fill) <= 1.03 * packing.lower_bound(np.array(lengths), 64)


def test_lower_bounds_hold():
    rng = random.Random(5)
    for _ in range(200):
        lengths = np.array([rng.randint(1, 20) for _ in range(rng.randint(1, 30))])
        assert packing.lower_bound(lengths, 20) <= len(packing.best_fit(lengths, 20))
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3
    assert packing.lower_bound(np.array([7] * 6), 20) == 3


# joins --------------------------------------------------------------------------------------------------------------

def test_hot_keys_are_spread(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") == 1, None).otherwise(F.col("id")).alias("k"))
    unique = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = {r.id: (r.k, r.v) for r in common.join_unique(big, unique, "k", F.col("id")).collect()}
    assert len(got) == 3000 and got[1] == (None, None)
    assert all(v == (None if k is None else 2 * k) for k, v in got.values())
