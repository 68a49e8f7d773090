"""Connected components with the smallest vertex as root, by contraction.

Each round, every vertex points at the vertex that comes first in a random order of that round, of those at most two
edges away (after Boegeholz, Brand and Todor, "In-database connected component analysis", 2020, with one edge more, so
that a star is done at once). The pointed-at vertices are the next round's vertices: edges are relabelled, and those
inside a new vertex drop out. So vertices shrink by a constant factor a round, whatever the graph looks like. Before each round, every task replaces
its own edges by a spanning forest of them. Once no more than `rest` edges are left, one task joins them by
union-find: a bound, whatever the input's size. At last each round's pointers are followed back.

A pointer is a partially aggregated minimum per vertex, and relabelling joins the edges to a side that is unique per
vertex; so a hub costs one row per map task in the aggregation, and AQE can split its partition in the joins.
Every round ends in stage tables, which bounds the lineage and survives executor loss.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stage_table

#: Edges that one task may join by union-find (16 MB of vertex numbers).
REST = 1_000_000
#: Edges of which a task makes a forest at once.
EDGES_AT_ONCE = 500_000


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each component of the graph with edges a-b on 0..n-1."""
    root = np.arange(n)
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return root


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(u, v): each vertex of the edges with the smallest one of its component there, but for that one itself."""
    edges = pa.Table.from_batches(batches)
    ends = pa.chunked_array(edges.column(0).chunks + edges.column(1).chunks).combine_chunks()
    names = pc.unique(ends)
    names = names.take(pc.sort_indices(names))  # numbers in the order of names, so the smallest number is the root
    code = pc.index_in(ends, names).to_numpy(zero_copy_only=False)
    root = forest(code[:edges.num_rows], code[edges.num_rows:], len(names))
    apart = np.flatnonzero(root != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([names.take(pa.array(apart)), names.take(pa.array(root[apart]))], ["u", "v"])


def thin(edges: DataFrame) -> DataFrame:
    """(u, v) with the components of `edges`: every task makes spanning forests of its own edges, as stars, u > v."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * EDGES_AT_ONCE:  # at least half of it is new: what a forest leaves is fewer than its vertices
                held = [_stars(held)]
                rows = held[0].num_rows
                if rows >= EDGES_AT_ONCE:
                    yield held[0]
                    held, rows = [], 0
        if rows:
            yield _stars(held)

    kind = edges.schema["u"].dataType.simpleString()
    return edges.select("u", "v").mapInArrow(work, f"u {kind}, v {kind}")


def _joined(edges: DataFrame) -> DataFrame:
    """(u, v): as `thin`, by one task, so that its stars are those of the whole graph. For bounded edges."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield _stars(held)

    kind = edges.schema["u"].dataType.simpleString()
    return edges.coalesce(1).mapInArrow(work, f"u {kind}, v {kind}")


def _pointers(edges: DataFrame, turn: int) -> DataFrame:
    """(vertex, to) for every vertex of `edges`: the first vertex at most two edges away."""
    def first(rows: DataFrame) -> DataFrame:
        return rows.groupBy("u").agg(F.min_by("v", F.xxhash64("v", F.lit(turn))).alias("v"))

    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    own = edges.select("u", F.col("u").alias("v")).unionByName(edges.select(F.col("v").alias("u"), "v"))
    near = stage_table(first(both.unionByName(own)), "pointers")
    reach = both.join(near.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select("u", F.col("w").alias("v"))
    return first(reach.unionByName(near)).select(F.col("u").alias("vertex"), F.col("v").alias("to"))


def _relabelled(edges: DataFrame, pointers: DataFrame) -> DataFrame:
    u = pointers.select(F.col("vertex").alias("u"), F.col("to").alias("p"))
    v = pointers.select(F.col("vertex").alias("v"), F.col("to").alias("q"))
    return (edges.join(u, "u").join(v, "v").filter(F.col("p") != F.col("q"))
            .select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct())


def connected_components(edges: DataFrame, rest: int = REST) -> DataFrame:
    """(vertex, root) for every vertex of `edges` (columns src, dst) that is not its own root.

    Vertices are of any type with an order that Arrow knows as well (whole numbers, strings). Loops, repeated edges
    and both directions of one do no harm; an edge with a null end is none.
    """
    left = edges.filter(F.col("src") != F.col("dst")).select(F.col("src").alias("u"), F.col("dst").alias("v"))
    left = stage_table(thin(left), "edges")
    rounds: list[DataFrame] = []
    while left.count() > rest:
        rounds.append(stage_table(_pointers(left, len(rounds)), "pointers"))
        left = stage_table(thin(_relabelled(left, rounds[-1])), "edges")
    roots = stage_table(_joined(left).select(F.col("u").alias("vertex"), F.col("v").alias("root")), "roots")
    if not rounds:
        return roots
    for pointers in reversed(rounds):
        up = roots.select(F.col("vertex").alias("to"), "root")
        roots = stage_table(pointers.join(up, "to", "left").select("vertex", F.coalesce("root", "to").alias("root")), "roots")
    # the pointed-at vertex of a component is any of them: name it by its smallest
    least = roots.groupBy("root").agg(F.min("vertex").alias("least"))
    return (roots.join(least, "root").filter(F.col("vertex") != F.col("least"))
            .select("vertex", F.col("least").alias("root")))
