"""Registered queries of the operators in this package, over whole tables with production parameters."""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (decontaminate, host_quality, packing, periodic_runs, pii, quality_votes, secret_scan, simhash, spans,
               spelling, suffix_dedup, token_orc, toxic_passages, url_filter)
from .common import map_batches, table, utf8


#: The rules that every url of `pages` is judged by (fixed values).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(RULES, "url string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), listed)


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    token_orc.write(table(spark, sf_dir, "documents"), path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            crc = [zlib.crc32(ids[i].values.to_numpy().astype("<u4").tobytes()) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return token_orc.read(spark, path).mapInArrow(work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    return suffix_dedup.remove_repeats(docs, key=["_file", "_index"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.digest(secret_scan.scan(docs, secret_scan.fit(docs)), secret_scan.KINDS)


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_votes.fit(docs, table(spark, sf_dir, "labels"))
    return quality_votes.score(docs, model).select(
        "doc_id", quality_votes.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_votes.THRESHOLD).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"))
    rows = cut.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return rows.join(packing.plan(cut.select("key", "length")), "key").drop("key")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.digest(pii.scan(docs, pii.fit(docs)), pii.KINDS)


def _misspelt(doc_id: int, run: str) -> str:
    """The run as op11 takes it from a document: about one in 31 loses a code point."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), change=_misspelt)
    return spelling.forms(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_passages.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_passages.score(docs, model).select(
        "doc_id", toxic_passages.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxic_passages.THRESHOLD).cast("int").alias("predicted"), "evidence",
        F.size("passages").cast("long").alias("n_passages"))


def _with_loops(doc_id: int | None, text: bytes) -> bytes:
    """The text as op13 takes it: one in ten repeats a stretch of its words to its end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    words = text.split() if h % 10 == 0 else []
    if not words:
        return text
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [_with_loops(i, t) for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    docs = map_batches(table(spark, sf_dir, "documents").select("doc_id", "text"), work, "doc_id bigint, text string")
    return periodic_runs.digest(periodic_runs.scan(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_token_orc, op3_simhash, op4_host_quality, op5_suffix_dedup,
                            op6_decontaminate, op7_secret_scan, op8_quality_votes, op9_packing, op10_pii,
                            op11_spelling, op12_toxic_passages, op13_periodic_runs)}

ORACLES: dict[str, str] = {
    "op1_url_filter": r"""
        WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        split AS (SELECT row_number() OVER () AS n, page_id,
                         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
                  FROM pages),
        fits AS (SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                        arg_max(r.verdict, length(r.host || r.path)) AS verdict
                 FROM split s JOIN rules r ON ends_with('.' || s.host, '.' || r.host) AND starts_with(s.path, r.path)
                 GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (n)""",
    "op4_host_quality": r"""
        WITH docs AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents),
        split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
                  FROM docs),
        places AS (SELECT n, words, unnest(range(1, greatest(1, len(words) - 1))) AS i FROM split),
        often AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS c
                                    FROM places) WHERE c > 1),
        covered AS (SELECT n, count(DISTINCT i + d) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) v(d) GROUP BY n),
        measured AS (SELECT n, doc_id, source, len(words) AS n_words,
                            coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
                            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                            len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                            coalesce(n_repeat_words, 0) AS n_repeat_words
                     FROM split LEFT JOIN covered USING (n)),
        judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
        hosts AS (SELECT source, count(*) AS c, count(*) FILTER (base_failed) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
        common AS (SELECT sum(f) / sum(c) AS m FROM hosts),
        spread AS (SELECT any_value(m) AS m, avg(power(f / c - m, 2)) - avg(m * (1 - m) / c) AS v FROM hosts, common),
        prior AS (SELECT m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM spread),
        bad AS (SELECT source FROM hosts, prior WHERE (f + m * s) / (c + s) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND source NOT IN (SELECT source FROM bad) IS NOT FALSE AS kept
        FROM judged""",
}
