"""Connected components by repeated contraction, without gathering a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut


def connected(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges (a, b)``; equal roots mean one component.

    Each round sends every node to the neighbour, or itself, with the smallest scrambled
    id and contracts the graph along these moves. Scrambling makes a long chain shrink by a
    constant share a round, so the number of rounds is logarithmic in its length. Every
    round is a few shuffles of two-column rows and is cut into the checkpoint folder; the moves are
    put together at the end. An edge
    from a node to itself only lists the node. No edges give no rows.
    """
    graph = cut(edges.select("a", "b").distinct())
    steps: list[DataFrame] = []
    while not graph.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("id"))
        both = graph.select("a", "b").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = cut(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(rank(F.col("b"))).alias("near"))
            .select("node", F.least("near", rank(F.col("node")))["id"].alias("to"))
        )
        steps.append(moves)
        graph = cut(
            graph.join(moves.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(moves.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    if not steps:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = steps[0].select("node", F.col("to").alias("root"))
    for moves in steps[1:]:
        moved = moves.select(F.col("node").alias("root"), "to")
        labels = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return cut(labels)
