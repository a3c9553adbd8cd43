"""Connected components of links, as a distributed union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.session import pin

#: edges that a task makes stars of at once
AT_ONCE = 1 << 18


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one at most, and no node both gives and takes."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("gives"), F.lit(0).alias("takes")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    both = ends.groupBy("node").agg(F.sum("gives").alias("gives"), F.max("takes").alias("takes"))
    return both.filter("gives > 1 OR gives > 0 AND takes > 0").isEmpty()


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the smallest one that these edges connect it with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    parent = np.arange(len(nodes))
    while len(a):
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(parent, above := parent[parent]):
            parent = above
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
    some = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[some], nodes[parent[some]]


def _contracted(edges: DataFrame, roots: bool = False) -> DataFrame:
    """Edges that connect the same nodes: each task makes stars of its own, some at once. With ``roots``, the smallest node
    of a star has an edge to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= AT_ONCE:
                yield joined(held)
                held, count = [], 0
        if count:
            yield joined(held)

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = _stars(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
        if roots:
            least = np.unique(v)
            u, v = np.concatenate([u, least]), np.concatenate([v, least])
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node in a link; a component is named by its smallest node. Nodes are whole numbers.

    Alternating stars: tasks make stars of the edges that they have; then, in turn, every node hands its larger neighbours,
    then its smaller ones, over to the smallest node it sees, until all edges form stars around smallest nodes. Each round
    is written, which cuts lineage; a handful of rounds suffice, as distances shrink by halves. Smallest neighbours are
    written before they are joined, so that the rows of a hub can be split. No more edges than a task makes stars of at
    once need no round: one task ends them, of that many at most. A link of a node with itself, or with a null, links
    nothing. Links are read more than once.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u <> v")
    few = edges.count() <= AT_ONCE
    if not few:
        edges = pin(_contracted(edges), "edges")
    while not few and not (few := edges.count() <= AT_ONCE):
        if _is_forest_of_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct()
        both = edges.union(edges.select("v", "u"))
        least = pin(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        handed = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = pin(handed.distinct(), "edges")
        least = pin(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        handed = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = pin(_contracted(handed.union(least.select(F.col("u"), F.col("m").alias("v"))).distinct()), "edges")
    return pin(_contracted(edges.coalesce(1), roots=True), "components").toDF("node", "component")
