"""Entity resolution: records that name the same place become one entity.

Records share an entity when they have the same name key, or the same address
block (address, state, ZIP) and similar names. Similar means: same first word,
or at least half of all words shared (Jaccard >= 1/2).

No pair of a block is ever listed. Both rules become stars that give exactly the
same components:

* Same first word is an equivalence, so each name links to the smallest key of
  its (block, first word).
* Jaccard >= 1/2 of word sets A and B means 3 * |A & B| >= |A| + |B|. So some
  common subset S has 3 * |S| >= |A| + |B|. For one S, let M be its shortest
  holder: if A and B qualify through S, each qualifies with M as well, because M
  is no longer than either. Linking every qualifying holder of S to M therefore
  gives the same components, in as many edges as there are holders. Only subsets
  with 2 * |S| >= |A| can qualify.

Names with the same set of words are one case: the smallest key stands for them.

Names with more than `subset_words` words have too many subsets. They meet at
pairs of rare words instead (see `long_name_edges`), exact for any length: the
names of one meeting are compared in a task, and only a forest of verified pairs
leaves it. So edges are linear in the names. Before that, names that stand next
to each other in a few cheap meetings are compared (see `near_links`): what these
pairs have joined already needs no exact meeting any more.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blank_words, normalize_address, normalize_name, strip_ws, zip5_key
from ..session import stage_table
from .components import connected_components

BLOCK = ["address", "state", "zip"]
SUBSET_WORDS = 10
#: Names with a common pair of words that one task compares; a cell of two parts has twice as many.
HOLDERS = 20_000
#: Cheap meetings of a long name, and how far apart two names may stand there to be compared.
SEEDS = 3
NEIGHBOURS = 3


def keyed_records(records: DataFrame) -> DataFrame:
    """Normalised name, place and name key of each record.

    Input: record_id, name, address, zip, state. A name/ZIP pair seen in several
    states keeps the state in its key; a record without ZIP or state gets a key
    of its own and the review flag.
    """
    # small files would make one task of all the text work below
    dealt = records.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), "record_id")
    norm = dealt.select(
        "record_id",
        normalize_name(F.col("name")).alias("_name"),
        normalize_address(F.col("address")).alias("address"),
        zip5_key(F.col("zip")).alias("zip"),
        F.upper(strip_ws(F.coalesce("state", F.lit("")))).alias("state"))
    norm = norm.withColumn("name", F.when(F.col("_name") != "", F.col("_name")).otherwise(
        F.concat(F.lit("UNNAMED "), F.col("record_id").cast("string")))).drop("_name")
    norm = stage_table(norm, "normalised")
    complete = (F.col("zip") != "") & (F.col("state") != "")
    # only pairs that do span states are kept: a small right side, unique per key
    several = (norm.filter(complete).groupBy("name", "zip")
               .agg(F.min("state").alias("_lo"), F.max("state").alias("_hi"))
               .filter(F.col("_lo") != F.col("_hi"))
               .select("name", "zip", F.lit(True).alias("several")))
    bar = F.lit("|")
    return norm.join(several, ["name", "zip"], "left").select(
        "record_id", "name", "address", "state", "zip", (~complete).alias("review_required"),
        F.when(~complete, F.concat("name", bar, "state", bar, "zip", F.lit("|REVIEW|"),
                                   F.col("record_id").cast("string")))
        .when(F.col("several"), F.concat("name", bar, "state", bar, "zip"))
        .otherwise(F.concat("name", bar, "zip")).alias("key"))


def block_members(keyed: DataFrame) -> DataFrame:
    """Distinct (block, key) rows; blocks need ZIP, state and an address with a digit."""
    return (keyed.filter((F.col("state") != "") & (F.col("zip") != "") & F.col("address").rlike("[0-9]"))
            .groupBy(*BLOCK, "key").agg(F.min("name").alias("name"))
            .withColumn("word_set", F.array_sort(F.array_distinct(blank_words(F.col("name"))))))


def word_sets(members: DataFrame) -> DataFrame:
    """One row per block and word set: its smallest key, the first word of that key's name, its number of words."""
    return (members.groupBy(*BLOCK, "word_set").agg(F.min(F.struct("key", "name")).alias("_least"))
            .select(*BLOCK, "word_set", F.col("_least.key").alias("key"), F.size("word_set").alias("n"),
                    F.substring_index("_least.name", " ", 1).alias("first")))


def word_set_edges(members: DataFrame, sets: DataFrame) -> DataFrame:
    hubs = sets.select(*BLOCK, "word_set", F.col("key").alias("dst"))
    return (members.join(hubs, [*BLOCK, "word_set"]).filter(F.col("key") != F.col("dst"))
            .select(F.col("key").alias("src"), "dst"))


def first_word_edges(members: DataFrame) -> DataFrame:
    spots = members.withColumn("first", F.substring_index("name", " ", 1)).select(*BLOCK, "first", "key")
    hubs = (spots.groupBy(*BLOCK, "first").agg(F.min("key").alias("dst"), F.max("key").alias("_last"))
            .filter(F.col("dst") != F.col("_last")).drop("_last"))
    return (spots.join(hubs, [*BLOCK, "first"]).filter(F.col("key") != F.col("dst"))
            .select(F.col("key").alias("src"), "dst"))


def _subsets(word_set: Column) -> Column:
    """All subsets with at least half of the words, as texts (words hold no blank)."""
    start = F.array(F.array().cast("array<string>"))
    grown = F.aggregate(word_set, start,
                        lambda acc, w: F.concat(acc, F.transform(acc, lambda s: F.concat(s, F.array(w)))))
    half = F.filter(grown, lambda s: F.size(s) * 2 >= F.size(word_set))
    return F.filter(half, lambda s: F.size(s) > 0)


def subset_edges(sets: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """Star edges through common word subsets, for names of up to `subset_words` words."""
    holders = (sets.filter(F.col("n") <= subset_words)
               .select(*BLOCK, "key", "n",
                       F.explode(_subsets(F.col("word_set"))).alias("s"))
               .select(*BLOCK, "key", "n", F.size("s").alias("k"), F.array_join("s", " ").alias("s")))
    hubs = (holders.groupBy(*BLOCK, "s")
            .agg(F.min(F.struct("n", "key")).alias("_min"), F.count(F.lit(1)).alias("_holders"))
            .filter(F.col("_holders") > 1)
            .select(*BLOCK, "s", F.col("_min.n").alias("hub_n"), F.col("_min.key").alias("dst")))
    return (holders.join(hubs, [*BLOCK, "s"])
            .filter((F.col("key") != F.col("dst")) & (F.col("n") + F.col("hub_n") <= 3 * F.col("k")))
            .select(F.col("key").alias("src"), "dst"))


def _floor_words(subset_words: int) -> int:
    """Words that a name similar to one of more than `subset_words` words has at least."""
    return (subset_words + 2) // 2


def _open_blocks(names: DataFrame, label: str, subset_words: int) -> DataFrame:
    """Names of the blocks that have a long name and more than one `label`; in others there is nothing to join."""
    blocks = (names.groupBy(*BLOCK).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"), F.max("n").alias("_most"))
              .filter((F.col("_lo") != F.col("_hi")) & (F.col("_most") > subset_words)).select(*BLOCK))
    return names.join(blocks, BLOCK, "left_semi")


def families(sets: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """Names that may be similar to a long name with another first word; `family` is the smallest key of theirs in the
    block that begins with the same word, so a name belongs to its family by `first_word_edges`."""
    sized = _open_blocks(sets.filter(F.col("n") >= _floor_words(subset_words)), "first", subset_words)
    hubs = sized.groupBy(*BLOCK, "first").agg(F.min("key").alias("family"))
    return sized.join(hubs, [*BLOCK, "first"])


def _shared_words(codes: np.ndarray, starts: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of words that names i[p] and j[p] share, for each pair p; a name's words are different."""
    base = int(codes.max(initial=0)) + 1

    def marked(rows: np.ndarray) -> np.ndarray:
        n = size[rows]
        at = np.arange(n.sum()) + np.repeat(starts[rows] - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(rows)), n) * base + codes[at]

    both = np.intersect1d(marked(i), marked(j), assume_unique=True)
    return np.bincount(both // base, minlength=len(i))


def near_links(names: DataFrame) -> DataFrame:
    """(src, dst): families with a pair of similar names that stand close together in a cheap meeting.

    A name goes to one meeting for each seed, by the smallest hash of its words, which two similar names share with a
    chance of a half and more. A meeting is sorted by words and each name compared with the next few, so the work
    is linear in the names, whatever they are. Pairs that are missed are left to the exact meetings.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            words, names = rows.column("ws"), rows.column("family")
            codes = words.flatten().dictionary_encode().indices.to_numpy()
            starts = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
            size = np.diff(np.append(starts, len(codes)))
            family = names.dictionary_encode().indices.to_numpy()
            g, b = (rows.column(c).to_numpy() for c in ("g", "b"))
            found = []
            for apart in range(1, NEIGHBOURS + 1):
                i = np.flatnonzero((g[apart:] == g[:-apart]) & (b[apart:] == b[:-apart]) & (family[apart:] != family[:-apart]))
                j = i + apart
                alike = 3 * _shared_words(codes, starts, size, i, j) >= size[i] + size[j]
                found.append(np.stack([i[alike], j[alike]]))
            i, j = np.concatenate(found, axis=1)
            _, at = np.unique(np.stack([family[i], family[j]]), axis=1, return_index=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(x[at], pa.int64())) for x in (i, j)], ["src", "dst"])

    def meeting(seed: int) -> Column:
        named = [*map(F.col, BLOCK), F.lit(seed), F.array_min(F.transform("word_set", lambda w: F.xxhash64(w, F.lit(seed))))]
        return F.struct(F.xxhash64(*named).alias("g"), F.xxhash64(F.lit("b"), *named).alias("b"))

    met = names.select(F.inline(F.array(*map(meeting, range(SEEDS)))), "family", F.col("word_set").alias("ws"))
    return (met.repartitionByRange("g", "b", "ws").sortWithinPartitions("g", "b", "ws")
            .mapInArrow(work, "src string, dst string"))


def long_name_probes(sets: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """(g, b, cell, key, first, ws): names that meet at a pair of words of one block, as rows of one comparison.

    Prefix filtering with two words: two sets that share at least c words, put in
    one common order, share at least two words among the first n - c + 2 of each.
    c is at least half the size of either set, so each name joins on the word
    pairs of that prefix, rarest words of the block first. A partner of a long
    name has more than half as many words. Two hashes, g and b, name a pair of
    words in its block.

    A pair of words that more than HOLDERS names have is dealt out: its holders
    go to parts by a hash, and each two parts meet in a cell of their own.
    """
    sized = sets.filter(F.col("n") >= _floor_words(subset_words))
    tokens = sized.select(*BLOCK, "key", "n", "first", F.explode("word_set").alias("w"))
    rarity = tokens.groupBy(*BLOCK, "w").agg(F.count(F.lit(1)).alias("df"))
    # a name's own words: bounded by its text, not by the group
    ordered = (tokens.join(rarity, [*BLOCK, "w"]).groupBy(*BLOCK, "key", "n", "first")
               .agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("ws"))
               .withColumn("ws", F.transform("ws", lambda x: x["w"])))
    prefix = F.slice("ws", 1, F.col("n") - F.ceil(F.col("n") / 2).cast("int") + 2)
    pairs = F.flatten(F.transform(prefix, lambda a, i: F.transform(
        F.slice(prefix, i + 2, F.size(prefix)), lambda b: F.concat_ws(" ", F.least(a, b), F.greatest(a, b)))))
    named = [*map(F.col, BLOCK), F.col("probe")]
    probes = stage_table(ordered.select("*", F.explode(F.array_distinct(pairs)).alias("probe")).select(
        F.xxhash64(*named).alias("g"), F.xxhash64(F.lit("b"), *named).alias("b"), "key", "n", "first", "ws"), "probes")
    # pairs of words whose holders all begin with the same word, or are all short, have nothing to add
    mixed = (probes.groupBy("g", "b").agg(F.min("first").alias("_lo"), F.max("first").alias("_hi"),
                                          F.max("n").alias("_most"), F.count(F.lit(1)).alias("_holders"))
             .filter((F.col("_lo") != F.col("_hi")) & (F.col("_most") > subset_words))
             .select("g", "b", F.ceil(F.col("_holders") / HOLDERS).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda j: F.least(part, j) * F.col("parts") + F.greatest(part, j))
    return probes.join(mixed, ["g", "b"]).select("g", "b", F.explode(cells).alias("cell"), "key", "first", "ws")


def family_links(codes: np.ndarray, starts: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of similar names that join what all similar pairs join; `codes` are the names' words, name after name.

    Names with the same number in `first` belong together from the start. A name
    is compared with all others at once, and only names outside the largest
    family need be: what joins two families has an end in a smaller one. So a
    group that is one family takes one comparison for each name.
    """
    size = np.diff(np.append(starts, len(codes)))
    _, family = np.unique(first, return_inverse=True)
    compared = np.zeros(len(size), bool)
    mark = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    links = []
    while True:
        largest = np.bincount(family).argmax()
        rest = np.flatnonzero(~compared & (family != largest))
        if not len(rest):
            return links
        i = int(rest[0])
        compared[i] = True
        own = codes[starts[i]:starts[i] + size[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[codes], starts)
        mark[own] = 0
        found = (3 * shared >= size + size[i]) & (family != family[i])
        if found.any():
            joined, at = np.unique(family[found], return_index=True)
            links += [(i, int(j)) for j in np.flatnonzero(found)[at]]
            family[np.isin(family, joined)] = family[i]


def long_name_edges(sets: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """Edges that join similar names, at least one of them longer than `subset_words` words, with different first words.

    Each comparison yields a forest of verified pairs: fewer edges than names. Names that the near links have put in
    one component count as one family, and only blocks with several families left go to the exact meetings.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, 3):
            words = rows.column("ws").combine_chunks()
            codes = words.flatten().dictionary_encode().indices.to_numpy()
            starts = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
            first = rows.column("first").combine_chunks().dictionary_encode().indices.to_numpy()
            keys = rows.column("key")
            src, dst = [], []
            for lo, hi in _runs(rows, 3):
                end = starts[hi] if hi < len(starts) else len(codes)
                for i, j in family_links(codes[starts[lo]:end], starts[lo:hi] - starts[lo], first[lo:hi]):
                    src.append(lo + i)
                    dst.append(lo + j)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(x, pa.int64())).combine_chunks() for x in (src, dst)], ["src", "dst"])

    names = stage_table(families(sets, subset_words), "families")
    roots = connected_components(near_links(names))
    joined = names.join(roots.withColumnRenamed("vertex", "family"), "family", "left").withColumn("first", F.coalesce("root", "family"))
    groups = long_name_probes(_open_blocks(joined.select(*sets.columns), "first", subset_words), subset_words)
    exact = (groups.repartition("g", "b", "cell").sortWithinPartitions("g", "b", "cell")
             .mapInArrow(work, "src string, dst string"))
    return exact.unionByName(roots.select(F.col("vertex").alias("src"), F.col("root").alias("dst")))


def _runs(rows: pa.Table, keys: int) -> list[tuple[int, int]]:
    """(first, end) of each run of rows that are equal in the first `keys` columns, whole numbers."""
    key = np.stack([rows.column(i).to_numpy() for i in range(keys)])
    cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), rows.num_rows]))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted rows in tables that cut no run of rows with equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first, last = ([batch.column(i)[at].as_py() for i in range(keys)] for at in (0, -1))
        if held and first != [held[-1].column(i)[-1].as_py() for i in range(keys)]:
            yield pa.Table.from_batches(held)
            held = []
        if first != last:  # what comes before the last run is whole
            cut = _runs(pa.Table.from_batches([batch]), keys)[-1][0]
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def similarity_edges(keyed: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """Edges whose components equal those of all similar pairs inside blocks."""
    members = stage_table(block_members(keyed), "members")
    sets = stage_table(word_sets(members), "word-sets")
    return (first_word_edges(members)
            .unionByName(word_set_edges(members, sets))
            .unionByName(subset_edges(sets, subset_words))
            .unionByName(long_name_edges(sets, subset_words)))


def short_id(root: Column) -> Column:
    return F.concat(F.lit("f"), F.substring(F.sha1(root), 1, 10))


def resolve(records: DataFrame, subset_words: int = SUBSET_WORDS) -> DataFrame:
    """(record_id, facility_id, review_required) for every record."""
    # read five times below: normalise and key each record once
    keyed = stage_table(keyed_records(records), "keyed")
    roots = connected_components(similarity_edges(keyed, subset_words))
    return (keyed.select("record_id", "review_required", F.col("key").alias("vertex"))
            .join(roots, "vertex", "left")
            .select("record_id", short_id(F.coalesce("root", "vertex")).alias("facility_id"),
                    "review_required"))
