"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (columns a, b, any hashable type).

    Each round hooks every node to the neighbour (or itself) with the least hash
    and contracts the edges, so the graph shrinks by a constant share a round
    whatever its shape; stars of any size vanish in one round. Each round's hooks
    are kept and composed afterwards, last round first. Minima are aggregated
    before the shuffle and the relabelling joins split large keys, so a node with
    very many edges is no burden. Only edge counts reach the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = materialize(both.where("a <> b").distinct(), "edges")
    hooks = []
    while not live.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
        least = live.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a")))["node"].alias("root"))
        hook = materialize(least.select(F.col("a").alias("node"), "root"), "hooks")
        hooks.append(hook)
        left = live.join(hook.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        both = left.join(hook.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        live = materialize(both.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if not hooks:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hooks.pop()
    while hooks:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        earlier = hooks.pop()
        roots = earlier.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return roots
