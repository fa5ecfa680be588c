"""Connected components by alternating large-star and small-star contraction.

Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014.  The
number of rounds grows with the logarithm of the graph's size, not with its
diameter, and each round is two equi joins on aggregated minima: no adjacency
list is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "k"))
    far = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return far.where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    near = down.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return near.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def _round(e: DataFrame, rows: int | None) -> tuple[DataFrame, tuple]:
    """``e``, of some ``rows``, written out, with the number and a digest of its rows that are no loops, observed while it is written."""
    seen = Observation()
    digest = F.expr("bit_xor(if(u <> v, xxhash64(u, v), 0))")
    out = materialise(e.observe(seen, F.count_if(F.expr("u <> v")).alias("n"), digest.alias("x")), "edges", rows)
    return out, (seen.get["n"], seen.get["x"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rows: int | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``edges``, some ``rows`` if that is known; the component is its least node.

    Self loops and repeated edges are harmless; edges with a null end are ignored.
    Nodes without a link to another do not appear unless through a self loop.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    written, state = _round(e.distinct(), rows)  # once: edges may be dear to compute
    loops, e = written.where("u = v").select("u"), written.where("u <> v")
    while state[0]:
        (e, new), before = _round(_small_star(_large_star(e)), 2 * state[0]), state
        if new == before:
            break
        state = new
    # Each node now points at its root, and roots point nowhere.
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return found.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
