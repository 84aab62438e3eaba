"""Connected components of a graph that is never in one place.

Alternating stars: each node's larger neighbours are linked to its smallest
one, then each node's smaller neighbours are, until nothing changes. Both steps
are an aggregation with map-side minima and a join that Spark may split, so a
node with a third of all edges is spread like any other. Rounds are logarithmic
in the longest path; each is checkpointed in the shared folder, in files by the
number of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``node, component`` (the smallest node reachable) for all nodes of ``a, b``, of which there are ``most`` rows at most.

    Loops and repeated edges do no harm; rows with a null are left out; an
    empty graph has no rows.
    """
    edges = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), most
    )
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)), state[0])  # neither step makes more edges than it is given
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))


def _state(edges: DataFrame) -> tuple:
    """Row count and two order-free checksums, made by the executors."""
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    linked = both.join(least, both.a == least.u).where("b > a and b <> m")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    linked = edges.join(least, edges.a == least.u).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return linked.union(least.select("u", "m")).distinct()
