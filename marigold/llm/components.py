"""Connected components of a graph that no single task or driver could hold.

Each round every node moves to the neighbour (or itself) that a random order of that round puts first, edges are
renamed accordingly, and edges within a node vanish. A chain halves each round and a star vanishes at once. All
steps are equi-joins and groupings with a map-side minimum, so a hub with a third of all edges is split like any
skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marigold.staging import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b``: the least node that its links reach.

    Nodes may be any one type that has an order and a hash. Loops and repeated edges do no harm. The driver
    learns one number a round, how many edges are left.
    """
    edges = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges-0")
    moves = []
    while not edges.isEmpty():
        if len(moves) == MAX_ROUNDS:
            raise RuntimeError("components did not come to an end")
        salt = F.lit(len(moves))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", salt).alias("h"), F.col("b").alias("n"))).alias("best"))
        own = F.struct(F.xxhash64("a", salt).alias("h"), F.col("a").alias("n"))
        move = stage(best.select(F.col("a").alias("node"), F.least("best", own)["n"].alias("to")), f"moves-{len(moves)}")
        moves.append(move)
        renamed = edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        renamed = renamed.join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        edges = stage(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"edges-{len(moves)}")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = moves[0]
    for move in moves[1:]:
        step = move.select(F.col("node").alias("to"), F.col("to").alias("next"))
        labels = labels.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    labels = stage(labels, "labels")
    least = labels.groupBy("to").agg(F.min("node").alias("component"))
    return labels.join(least, "to").select("node", "component")
