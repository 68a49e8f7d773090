"""Secret scan: base kinds against the contract's patterns, the ratio against a plain version, and what is not a secret."""
import base64
import collections
import hashlib
import math
import random
import re
import string

import numpy as np
import pytest

from leadrank.llm import common, queries, secret_scan

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_base_kinds_equal_their_patterns():
    rng = random.Random(6)
    bits = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "api", '"', "'", " ", "  ", ":", "=", "abc", "x.y", "AKIA", "B" * 16,
            "A1" * 5, "0a" * 12, "f" * 23, "é", "\n", "ſecret", "K"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert sorted(s[:3] for s in secret_scan.base_spans(text)) == plain_base(text), text


def plain_ratio(texts, token):
    """Log-likelihood ratio counted pair by pair, with the same interpolation."""
    inner = set(secret_scan.ALPHABET[:secret_scan.INNER])
    counts = [collections.Counter(), collections.Counter()]
    for text in texts:
        left, at = "", 0
        for s, _, e in plain_base(text):
            if s >= at:
                left += text[at:s] + "\0"
            at = max(at, e)
        words = re.findall("[A-Za-z0-9+]+", left + text[at:])
        values = [m[1] for m in ASSIGN.finditer(text) if len(m[1]) >= 6] + [text[s:e] for s, k, e in plain_base(text) if k]
        for label, parts in ((0, words), (1, [p for v in values for p in re.findall("[A-Za-z0-9+]+", v)])):
            for p in parts:
                counts[label].update(zip([None, *p], p))
        counts[0].update((a[-1], b[0].upper()) for a, b in zip(words, words[1:]))
        counts[0].update((a[0].upper(), a[1]) for a in words if len(a) > 1)
    total = [collections.Counter() for _ in counts]
    single = [collections.Counter() for _ in counts]
    for label in (0, 1):
        for (a, b), n in counts[label].items():
            total[label][a] += n
            single[label][b] += n
    sums = [sum(x.values()) for x in single]
    plain = lambda b: sum((single[k][b] + 1) / (sums[k] + 63) for k in (0, 1)) / 4 + 0.5 / 63
    def p(label, share, a, b):
        return (1 - share) * counts[label][a, b] / total[label][a] + share * plain(b) if total[label][a] else plain(b)
    out = 0.0
    for part in re.findall("[A-Za-z0-9+]+", token):
        assert set(part) <= inner
        out += sum(math.log(p(1, 0.5, a, b)) - math.log(p(0, 0.1, a, b)) for a, b in zip([None, *part], part))
    return out


def test_ratio_equals_plain_counts(spark, docs_of):
    # words of different texts do not join: one text a batch of its own cannot be had, so one text is enough here
    text = "The Meadow of_stone 42 rivers é password = 'Zk39vQpL77xw' then " + "0a1b" * 8 + " AKIA" + "Q7" * 9
    ratio = secret_scan.fit(docs_of([(1, text)]))
    for token in ["meadow", "Zk39vQ", "abc/def_ghi", "x", "0f0f", "a+b==", "stoneMeadow42"]:
        assert math.isclose(ratio.of_token(token), plain_ratio([text], token), abs_tol=1e-9), token


@pytest.fixture(scope="module")
def ratio(spark):
    return secret_scan.fit(common.table(spark, MIDDLE, "documents"))


def test_ordinary_text_is_no_secret(ratio):
    for text in ["-" * 40, "=" * 60, "_" * 30, "=-" * 20, "/usr/local/lib/python3/dist-packages/numpy", "AbstractSingletonProxyFactoryBean",
                 "a_rather_long_snake_case_name_of_a_function", "getElementByIdAndNameOrNull", "https://www.example.com/the/other/page.html",
                 "internationalization", "Donaudampfschifffahrtsgesellschaft", "AAAAAAAAAAAAAAAAAAAAAAAA", "2024-01-01T00-00-00", "00000000000000000000"]:
        assert not secret_scan.find(f"see {text} there", ratio), text


def test_random_strings_are_found(ratio):
    rng = random.Random(9)
    letters = string.ascii_letters + string.digits
    caught = {n: sum(bool(secret_scan.find("see " + "".join(rng.choice(letters) for _ in range(n)) + " there", ratio)) for _ in range(200)) / 200
              for n in (12, 16, 19, 24, 40)}
    assert caught[12] > 0.85 and min(caught[n] for n in (16, 19, 24, 40)) > 0.95, caught
    coded = [base64.b64encode(hashlib.sha256(bytes([i])).digest()).decode() for i in range(100)]
    assert sum(bool(secret_scan.find(f"key {x} there", ratio)) for x in coded) > 97


def test_documents_are_left_alone(spark, ratio):
    """What is found beside the base kinds in the test documents: nothing, as they hold no other random strings."""
    texts = [r.text or "" for r in common.table(spark, MIDDLE, "documents").collect()]
    added = [t[s:e] for t in texts for s, k, e, base in secret_scan.find(t, ratio) if not base]
    assert len(added) <= len(texts) // 500, added[:20]


def test_query_as_registered(spark):
    got = {r.doc_id: r for r in queries.op7_secret_scan(spark, SMALL).collect()}
    for r in common.table(spark, SMALL, "documents").collect():
        want = plain_base(r.text or "")
        listed = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in want)
        row = got[r.doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == x for _, k, _ in want) for x in range(3)]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) <= {*row.spans.split(","), ""}
