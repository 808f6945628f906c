"""Connected components of an edge list, entirely as Spark jobs.

Alternating large-star and small-star steps: every node first hooks its larger
neighbours onto the smallest node it sees, then its smaller ones. The edge list
ends as a forest of stars whose centres are the smallest ids. Minima are
aggregated before the shuffle and attached by a join whose hot side adaptive
execution can split, so a hub with millions of edges never sits in one task;
nothing is collected but the answer whether the forest is done. Each round is a written table,
and first of all every task shrinks its own edges to a forest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find over nodes 0..n-1 in numpy: for each node the smallest node of its component."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _contract(batches):
    """Replace each batch of edges by a forest of stars with the same components."""
    for pdf in batches:
        nodes, codes = np.unique(np.concatenate([pdf.a.to_numpy(), pdf.b.to_numpy()]), return_inverse=True)
        k = len(pdf)
        root = local_roots(len(nodes), codes[:k], codes[k:])
        own = np.flatnonzero(root != np.arange(len(nodes)))
        yield pd.DataFrame({"a": nodes[own], "b": nodes[root[own]]})


def _settled(edges: DataFrame) -> bool:
    """Is the edge list a forest of stars: every leaf has one centre, no centre is a leaf?"""
    ends = edges.select(F.col("a").alias("k"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("k").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where("leaf + centre > 1").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """A written table ``edges(a long, b long)`` to ``(node, component)``, component = smallest reachable id.

    Only nodes of some edge between two different nodes are returned. Edges
    with a null end are ignored. Raises if ``max_rounds`` rounds do not settle.
    """
    edges = stored(edges.where("a <> b").select("a", "b").mapInPandas(_contract, "a long, b long"), "cc-edges")
    for _ in range(max_rounds):
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = stored(small, "cc-round")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
