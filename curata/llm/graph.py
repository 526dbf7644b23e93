"""Connected components of an edge table, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.session import checkpoint_dir


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``(node, component)`` per node of ``edges``; ``component`` is the smallest node it is connected to.

    Alternates the large-star and small-star steps of Kiveris et al.
    ("Connected Components in MapReduce and Beyond"): each round re-links
    every node's neighbours to the smallest of them, so the rounds grow with
    the logarithm of the longest path. Minima are combined before the
    shuffle, and every round is cut with ``checkpoint()``. Null nodes and
    self-links are left out.
    """
    checkpoint_dir(edges.sparkSession)
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = _star(both, F.col("e.v") > F.col("e.u"))            # large star: larger neighbours go to the minimum
        e = _star(e, F.lit(True)).checkpoint()                   # small star: smaller neighbours and the node itself
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == seen:
            break
        seen = now
    # at the fixed point every edge is a leaf and its component's smallest node
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _star(e: DataFrame, moved) -> DataFrame:
    """For each u: its smallest neighbour m (or u itself); links (v, m) for the neighbours ``moved``, and (u, m)."""
    least = e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    # the hashed second key gives the join its own exchange, which AQE can split when one node has very many links
    j = e.alias("e").join(least.alias("l"), (F.col("e.u") == F.col("l.u")) & (F.xxhash64("e.u") == F.xxhash64("l.u")))
    links = F.array(F.struct(F.when(moved, F.col("e.v")).alias("u"), F.col("l.m").alias("v")),
                    F.struct(F.col("e.u").alias("u"), F.col("l.m").alias("v")))
    return j.select(F.inline(links)).where("u is not null and u <> v").distinct()
