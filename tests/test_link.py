import itertools
import random

import pyarrow as pa
import pytest

from leadrank.operators import components, link
from leadrank.operators.components import connected_components
from leadrank.session import stage_table

SCHEMA = "record_id string, name string, address string, zip string, state string"


def brute_force(rows):
    """Groups by comparing every pair of a block; rows are already normal (upper case, plain words)."""
    states = {}
    for r, n, a, z, s in rows:
        if z and s:
            states.setdefault((n, z), set()).add(s)
    key = {}
    for r, n, a, z, s in rows:
        key[r] = f"{n}|{s}|{z}|REVIEW|{r}" if not (z and s) else (
            f"{n}|{s}|{z}" if len(states[(n, z)]) > 1 else f"{n}|{z}")
    root = {k: k for k in key.values()}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, y in itertools.combinations(rows, 2):
        if x[2:] == y[2:] and x[3] and x[4] and any(c.isdigit() for c in x[2]):
            a, b = set(x[1].split()), set(y[1].split())
            if x[1].split()[0] == y[1].split()[0] or len(a & b) / len(a | b) >= 0.5:
                p, q = sorted((find(key[x[0]]), find(key[y[0]])))
                root[q] = p
    return {r: find(k) for r, k in key.items()}


def groups(mapping):
    out = {}
    for record, entity in mapping.items():
        out.setdefault(entity, set()).add(record)
    return {frozenset(g) for g in out.values()}


@pytest.mark.parametrize("seed, longest, subset_words, holders", [(1, 5, 10, 9), (2, 9, 4, link.HOLDERS), (2, 9, 4, 3), (3, 16, 10, 5)])
def test_same_groups_as_all_pairs(spark, monkeypatch, seed, longest, subset_words, holders):
    monkeypatch.setattr(link, "HOLDERS", holders)
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(14)]
    rows = []
    for i in range(220):
        name = " ".join(rng.sample(vocabulary, rng.randint(1, min(longest, len(vocabulary)))))
        rows.append((str(i), name, f"{rng.randint(1, 4)} MAIN ST", rng.choice(["11111", "22222", ""]),
                     rng.choice(["AA", "BB"])))
    got = link.resolve(spark.createDataFrame(rows, SCHEMA).repartition(5), subset_words)
    mapping = {r.record_id: r.facility_id for r in got.collect()}
    assert groups(mapping) == groups(brute_force(rows))


def test_one_block_with_most_records(spark):
    """A block that holds most rows, all sharing words: edges stay linear in the names."""
    rows = [(str(i), f"N{i} PARK SERVICES UNITED", "1 PARK RD", "33333", "CC") for i in range(600)]
    rows += [(str(1000 + i), f"M{i} OTHER", f"{i} SIDE ST", "33333", "CC") for i in range(200)]
    keyed = link.keyed_records(spark.createDataFrame(rows, SCHEMA))
    assert link.similarity_edges(keyed).count() < 600 * 15
    mapping = {r.record_id: r.facility_id for r in link.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len({mapping[str(i)] for i in range(600)}) == 1 and len(set(mapping.values())) == 201


def test_long_names_that_begin_alike(spark):
    """2,000 long names of one block with one first word: no pairs are formed."""
    words = [f"W{i}" for i in range(30)]
    rng = random.Random(8)
    rows = [(str(i), "ALFA " + " ".join(rng.sample(words, 12)) + f" N{i}", "1 PARK RD", "33333", "CC") for i in range(2000)]
    rows += [(str(2000 + i), "BETA " + " ".join(rng.sample(words, 3)), "1 PARK RD", "33333", "CC") for i in range(20)]
    sets = link.word_sets(link.block_members(link.keyed_records(spark.createDataFrame(rows, SCHEMA))))
    assert link.long_name_edges(sets).count() == 0
    assert link.first_word_edges(link.block_members(link.keyed_records(spark.createDataFrame(rows, SCHEMA)))).count() == 2018


def test_long_names_that_begin_differently(spark):
    rows = [(str(i), f"A{i} " + " ".join(f"W{j}" for j in range(12)), "1 PARK RD", "33333", "CC") for i in range(60)]
    rows += [(str(100 + i), " ".join(f"W{(j + i) % 12}" for j in range(12)), "1 PARK RD", "33333", "CC") for i in range(12)]
    sets = link.word_sets(link.block_members(link.keyed_records(spark.createDataFrame(rows, SCHEMA))))
    assert sets.count() == 61
    assert link.long_name_edges(sets).distinct().count() < 2 * 61  # a forest, where all pairs would be 1,830


@pytest.mark.parametrize("holders", [link.HOLDERS, 400])
def test_many_long_names_of_one_family(spark, monkeypatch, holders):
    """Names of one block, all similar and all with their own first word: edges and time stay linear."""
    monkeypatch.setattr(link, "HOLDERS", holders)
    names = 6000 if holders == link.HOLDERS else 1500
    common = " ".join(f"W{j}" for j in range(11))
    rows = [(str(i), f"A{i} {common}", "1 PARK RD", "33333", "CC") for i in range(names)]
    rows += [(f"x{i}", f"B{i} " + " ".join(f"V{i}X{j}" for j in range(9)) + " W0 W1", "1 PARK RD", "33333", "CC") for i in range(30)]
    sets = stage_table(link.word_sets(link.block_members(link.keyed_records(spark.createDataFrame(rows, SCHEMA)))), "sets")
    edges = stage_table(link.long_name_edges(sets), "edges")
    cells = stage_table(link.long_name_probes(sets), "cells")
    most = cells.groupBy("g", "b", "cell").count().agg({"count": "max"}).first()[0]
    assert edges.count() < cells.count() < 30 * names * (-(-names // holders) + 1) and most <= 3 * holders
    roots = connected_components(edges)
    assert roots.count() == names - 1 and roots.select("root").distinct().count() == 1


def test_groups_over_any_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(5), rng.randrange(3), 0, i) for i in range(200))
    table = pa.table([[r[c] for r in rows] for c in range(4)], names=["g", "b", "cell", "x"])
    for size in (1, 7, 40, 500):
        parts = list(link._whole_groups(iter(table.to_batches(max_chunksize=size)), 3))
        groups = [[tuple(r.values()) for r in t.slice(a, b - a).to_pylist()] for t in parts for a, b in link._runs(t, 3)]
        assert [x for g in groups for x in g] == rows and len(groups) == len({r[:3] for r in rows})


def test_review_and_states(spark):
    rows = [("1", "Alfa Mill", "1 Elm St", "", "AA"), ("2", "Alfa Mill", "1 Elm St", "", "AA"),
            ("3", "Alfa Mill", "1 Elm St", "44444", "AA"), ("4", "Alfa Mill", "1 Elm St", "44444", "BB"),
            ("5", "Alfa Mill Inc", "9 Far Rd", "44444-1234", " aa "), ("6", None, "2 Oak Ct", "55555", "AA"),
            ("7", "", "3 Oak Ct", "55555", "AA")]
    got = {r.record_id: r for r in link.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k for k, r in got.items() if r.review_required} == {"1", "2"}
    assert got["1"].facility_id != got["2"].facility_id and got["3"].facility_id != got["4"].facility_id
    assert got["3"].facility_id == got["5"].facility_id and got["6"].facility_id != got["7"].facility_id


def test_order_and_partitions_do_not_matter(spark):
    rows = [(str(i), f"A{i} B{i} A{i + 1}", f"{i % 3} ELM ST", "66666", "AA") for i in range(60)]
    first = {tuple(r) for r in link.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    second = {tuple(r) for r in link.resolve(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()}
    assert first == second


def test_components_chain_and_star(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(90)] + [("s", f"t{i}") for i in range(50)] + [("z", "z")]
    got = {r.vertex: r.root for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {**{f"c{i:03}": "c000" for i in range(1, 91)}, **{f"t{i}": "s" for i in range(50)}}
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def plain_roots(edges):
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {v: find(v) for v in root if find(v) != v}


CHAIN = [(i, i + 1) for i in range(3000)]
STAR = [(7000, i) for i in range(3000)] + [(i, 7000) for i in range(50)] + [(5, 5)]
SCATTERED = [(random.Random(i).randrange(900), random.Random(-i).randrange(900)) for i in range(700)]


@pytest.mark.parametrize("edges", [CHAIN, STAR, SCATTERED, [], [(4, 4)]])
@pytest.mark.parametrize("rest", [0, components.REST])
def test_roots_by_contraction(spark, monkeypatch, edges, rest):
    monkeypatch.setattr(components, "EDGES_AT_ONCE", 100)
    frame = spark.createDataFrame(edges + [(None, 1)], "src bigint, dst bigint").repartition(4)
    got = {r.vertex: r.root for r in connected_components(frame, rest).collect()}
    assert got == plain_roots(edges)


def test_roots_of_names(spark):
    edges = [(f"näme {a}", f"näme {b}") for a, b in SCATTERED]
    got = connected_components(spark.createDataFrame(edges, "src string, dst string"), 100).collect()
    assert {r.vertex: r.root for r in got} == plain_roots(edges)


@pytest.mark.parametrize("edges", [CHAIN, STAR, SCATTERED])
def test_a_round_halves_the_edges(spark, edges):
    frame = spark.createDataFrame(edges, "u bigint, v bigint").filter("u != v").repartition(4)
    after = components._relabelled(frame, components._pointers(frame, 0))
    assert 2 * after.count() <= len(edges)


def _long_family_names(n):
    rng = random.Random(5)
    return [(str(i), f"K{i % 17} " + " ".join(f"{c}{rng.randrange(2)}" for c in "PQRSTUVWXYZ"), f"{i % 2} PARK RD", "33333", "CC") for i in range(n)]


def test_joined_families_need_no_exact_meeting(spark, monkeypatch):
    """Blocks that cheap comparisons make one family send no name to the exact meetings; the groups stay the same."""
    rows = _long_family_names(900)
    sent, probes = [], link.long_name_probes
    monkeypatch.setattr(link, "long_name_probes", lambda sets, words: sent.append(sets.count()) or probes(sets, words))
    frame = spark.createDataFrame(rows, SCHEMA)
    quick = {tuple(r) for r in link.resolve(frame).collect()}
    monkeypatch.setattr(link, "near_links", lambda names: spark.createDataFrame([], "src string, dst string"))
    assert quick == {tuple(r) for r in link.resolve(frame).collect()}
    assert sent[0] == 0 and sent[1] > 800


def test_near_links_are_similar_names_of_one_block(spark):
    rows = _long_family_names(60) + [("x", "ONLY " + " ".join(f"N{j}" for j in range(12)), "0 PARK RD", "33333", "CC")]
    names = link.families(link.word_sets(link.block_members(link.keyed_records(spark.createDataFrame(rows, SCHEMA)))))
    held = {}
    for r in names.collect():
        held.setdefault(r.family, []).append((r.address, set(r.word_set)))
    found = link.near_links(names).collect()
    assert found and all(any(p == q and 3 * len(a & b) >= len(a) + len(b) for p, a in held[e.src] for q, b in held[e.dst]) for e in found)
