"""Connected components by random contraction, all in joins and partial aggregates.

In each round every node of an edge picks, from itself and its neighbours, the one with the
smallest hash of (round, node); the picks replace the nodes in all edges, loops and repeated
edges go, and so on until no edge is left. The hash is new in each round, so long chains shrink
by a constant factor a round in expectation, whatever their ids. No group is collected: the
picks are a partial ``min_by``, and every join has one row per node on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpress.session import use_checkpoints


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge (``a``, ``b``); one root per component.

    Loops and repeated edges are allowed; null ends are ignored.
    """
    use_checkpoints(edges.sparkSession)
    left = _clean(edges).checkpoint()
    roots, seed = None, 0
    while not left.isEmpty():
        seed += 1
        code = F.xxhash64(F.lit(seed), F.col("b"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        picks = (
            both.unionByName(both.select("a", F.col("a").alias("b")))
            .groupBy("a")
            .agg(F.min_by("b", F.struct(code, F.col("b"))).alias("pick"))
            .withColumnRenamed("a", "node")
            .checkpoint()
        )
        to = lambda end: picks.select(F.col("node").alias(end), F.col("pick").alias(f"{end}2"))
        if roots is None:
            roots = picks.withColumnRenamed("pick", "root")
        else:
            roots = (
                roots.join(picks.withColumnRenamed("node", "root"), "root", "left")
                .select("node", F.coalesce("pick", "root").alias("root"))
                .checkpoint()
            )
        left = _clean(
            left.join(to("a"), "a").join(to("b"), "b").select(
                F.col("a2").alias("a"), F.col("b2").alias("b")
            )
        ).checkpoint()
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).where(F.lit(False))
    return roots


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
