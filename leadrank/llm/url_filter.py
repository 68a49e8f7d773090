"""URLs judged by listed URLs: a blocked Bloom filter first, then an exact join.

A listed URL is a canonical host and the beginning of a path, like `example.com/de/`. It fits its host and all
subdomains where the path begins with its own. Each URL yields the keys that could be listed: its host without none,
one, two, ... of the first labels, with the beginnings of its path of listed lengths. The filter has one block of 256
bits per row; a key sets or tests eight bits of one block. So the probe is one join on the block number, and only keys
that pass it go to the exact join, which removes the false positives.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage_table
from .common import join_unique

BITS_PER_KEY = 16
#: Blocks of 256 bits that the broadcast filter has at most (8 MB of bits); longer lists only pass more false positives.
MAX_BLOCKS = 1 << 18
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def listed_keys(listed: DataFrame, url: str = "url", verdict: str = "verdict") -> DataFrame:
    """(key, host, path, verdict): canonical form of a list, one row per key. Null or empty urls name nothing and are
    left out. If an entry has several verdicts, block wins."""
    text = F.regexp_replace(F.col(url), "(?s)^.*?://", "")
    host = F.translate(F.substring_index(text, "/", 1), _UPPER, _LOWER)
    rest = F.substr(text, F.char_length(F.substring_index(text, "/", 1)) + 1)
    return (listed.filter(F.coalesce(F.col(url), F.lit("")) != "")
            .select(host.alias("host"), rest.alias("path"), F.col(verdict).alias("verdict"))
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .withColumn("key", F.concat("host", "path")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """Four longs with two bits each: one in the lower and one in the upper half."""
    h = F.xxhash64(key, F.lit(1))

    def one(i: int) -> Column:
        place = F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") + 32 * (i % 2)
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [one(2 * j).bitwiseOR(one(2 * j + 1)) for j in range(4)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter of the column `key`; blocks without a key are left out."""
    masks = {f"w{j}": m for j, m in enumerate(_masks(F.col("key")))}
    return (keys.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(n) for n, m in masks.items()])
            .groupBy("block").agg(*[F.bit_or(n).alias(n) for n in masks]))


def candidates(pages: DataFrame, labels: int, lengths: list[int]) -> DataFrame:
    """(row, key): host suffixes of up to `labels` labels with path beginnings of the given lengths."""
    part = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.least(F.size(part), F.lit(labels))),
                         lambda n: F.array_join(F.slice(part, -n, n), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.char_length("path"))
    return (pages.filter(F.col("host") != "").select("row", "path", F.explode(suffix).alias("suffix"), fitting.alias("fitting"))
            .select("row", "suffix", F.explode(F.transform("fitting", lambda n: F.substr("path", F.lit(1), n))).alias("start"))
            .select("row", F.concat("suffix", "start").alias("key")))


def judge(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", default: str = ALLOW,
          bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages`.

    `listed` has columns url and verdict (allow or block). The longest fitting entry wins, of equally long ones the
    last in text order. A url that fits none, a null one, or one without "://" gets a null rule and `default`. Repeated
    rows come out repeated; an empty list leaves all to the default; other columns are not read.
    """
    keys = stage_table(listed_keys(listed), "listed")
    rows = stage_table(pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                                    path_of(F.col(url)).alias("path"), F.monotonically_increasing_id().alias("row")), "urls")
    shape = keys.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("host", r"\."))).alias("labels"),
                     F.collect_set(F.char_length("path")).alias("lengths")).first()  # lengths: bounded by the longest path
    if not shape.n:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = max(1, min(max_blocks, -(-shape.n * bits_per_key // 256)))
    possible = (candidates(rows, shape.labels, sorted(shape.lengths)).withColumn("block", _block(F.col("key"), blocks))
                .join(F.broadcast(bloom_blocks(keys, blocks)), "block"))
    for j, mask in enumerate(_masks(F.col("key"))):
        possible = possible.filter(F.col(f"w{j}").bitwiseAND(mask) == mask)
    possible = stage_table(possible.select("row", "key"), "possible")
    best = (join_unique(possible, keys.select("key", "verdict"), "key", F.col("row"), "inner")
            .groupBy("row").agg(F.max(F.struct(F.char_length("key").alias("long"), "key", "verdict")).alias("best")))
    return (rows.join(best, "row", "left")
            .select("page_id", "host", "path", F.col("best.key").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
