"""Pages, trigram search and table lookups against plain versions."""
import random
import re

import pytest
from pyspark.sql import functions as F

from leadrank.operators import lists, lookup, paging, search


@pytest.mark.parametrize("rows", [0, 1, 500])
def test_pages_of_an_ordered_table(spark, rows):
    rng = random.Random(rows)
    data = [(rng.randrange(40), f"n{i}") for i in range(rows)]
    frame = spark.createDataFrame(data, "a long, b string").repartition(3)
    table = paging.ordered_table(frame, [F.desc("a"), F.asc("b")])
    want = sorted(data, key=lambda r: (-r[0], r[1]))
    assert len(table) == rows
    for offset, size in ((0, 5), (130, 60), (480, 60), (500, 5), (0, 1000), (7, 0)):
        got = [tuple(r) for r in table.page(offset, size, "place").collect()]
        assert got == [(*r, offset + i + 1) for i, r in enumerate(want[offset:offset + size])]


def test_a_deep_page_reads_two_partitions_at_most(spark):
    table = paging.ordered_table(spark.range(4_000_000).select(F.pmod(F.col("id") * 7919, F.lit(4_000_037)).alias("x")), [F.asc("x")])
    assert len(table.parts) > 2 and len(table.holding(1_000_000, 60)) <= 2
    page = table.page(1_000_000, 60)
    assert [r.x for r in page.collect()] == sorted(r.x for r in page.collect()) and page.count() == 60
    assert re.search(r"PartitionFilters: \[[^\]]*_part#", page._jdf.queryExecution().toString())


TEXTS = [(1, "Hill Forge, Inc."), (2, None), (2, "forge of HILLS"), (3, "aaaa"), (4, "né 漢字 straße"), (5, ""), (6, "ab")]


def test_trigram_candidates(spark):
    rows = spark.createDataFrame(TEXTS, "id long, x string")
    index = search.build_index(rows, "id", [F.col("x"), F.lit("zip 104")])
    for query, want in (("hill", {1, 2}), ("forge", {1, 2}), ("FORGE, inc", {1}), ("aaa", {3}), ("漢字 s", {4}), ("104", {1, 2, 3, 4, 5, 6}), ("nothing", set())):
        assert {r.id for r in index.candidates(query).collect()} == want, query
    assert index.candidates("ab") is None
    asked = {r.gram for r in index.postings("forge").collect()}
    assert asked == {"for", "org", "rge"}
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", index.postings("forge")._jdf.queryExecution().toString())
    assert search.build_index(rows.limit(0), "id", [F.col("x")]).candidates("hill").collect() == []


def test_indexed_search_equals_the_scan(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aboxt") for _ in range(rng.randint(1, 5)))
    leads = spark.createDataFrame([(f"f{i}", f"{word()} {word()}", rng.choice([None, word()]), rng.choice([None, f"{rng.randrange(100):05}"]))
                                   for i in range(300)], "facility_id string, name string, city string, zip5 string")
    cites = spark.createDataFrame([(f"f{rng.randrange(400)}", word(), word()) for _ in range(300)], "facility_id string, standard string, title string")
    index = lists.search_index(leads, cites)
    for query in [None, "", " ", "a", "00", "000", "nope nope", *(word() for _ in range(6)), leads.first().name]:
        got = {r.facility_id for r in lists.search_indexed(leads, cites, index, query).collect()}
        assert got == {r.facility_id for r in lists.search(leads, cites, query).collect()}, query


def test_range_join_equals_brute_force(spark):
    rng = random.Random(3)
    ranges = [(i, lo, lo + rng.choice([-1, 0, 1, 5, 60, 1000]), f"t{i}") for i in range(200) for lo in [rng.randint(-900, 900)]]
    ranges += [(200, None, 5, "x"), (201, -2 ** 40, 2 ** 40, "wide")]
    numbers = [rng.randint(-2200, 2200) for _ in range(300)] + [None, 2 ** 50, 7, 7]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i long, n long")
    got = {r.i: r.title for r in lookup.range_join(df, "n", spark.createDataFrame(ranges, "position long, lo long, hi long, title string"), ["title"]).collect()}
    want = {i: next((t for _, lo, hi, t in ranges if n is not None and lo is not None and lo <= n <= hi), None) for i, n in enumerate(numbers)}
    assert got == want


def test_large_range_table_makes_no_nested_loop(spark):
    ranges = spark.range(100_000).selectExpr("id AS position", "id * 10 AS lo", "id * 10 + 4 AS hi", "id AS title")
    found = lookup.range_join(spark.range(0, 1_000_000, 97).withColumnRenamed("id", "n"), "n", ranges, ["title"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.filter("title IS NOT NULL AND title <> n div 10 OR title IS NULL AND n % 10 < 5").count() == 0


def test_prefix_join_equals_brute_force(spark):
    rng = random.Random(4)
    part = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 5)))
    prefixes = [(i, part()) for i in range(60)] + [(60, None)]
    codes = [part() + part() for _ in range(200)] + [None, "zz", "zz"]
    for table in (prefixes, [x for x in prefixes if x[1] != ""], []):
        df = spark.createDataFrame(list(enumerate(codes)), "i long, c string")
        got = {r.i: r.p for r in lookup.prefix_join(df, "c", spark.createDataFrame(table, "position long, prefix string").withColumn(
            "p", F.col("position")), ["p"]).collect()}
        fits = lambda c: min(((-len(x), i) for i, x in table if c is not None and x is not None and c.startswith(x)), default=(0, None))[1]
        assert got == {i: fits(c) for i, c in enumerate(codes)}


def test_keyed_map(spark):
    rows = spark.createDataFrame([("b", 2, "y"), ("a", 1, None)], "id string, n long, t string")
    assert {k: tuple(v) for k, v in lists.keyed(rows, "id", ["n", "t"]).first().entries.items()} == {"a": (1, None), "b": (2, "y")}
    assert lists.keyed(rows.limit(0), "id", ["n"]).first().entries == {}
