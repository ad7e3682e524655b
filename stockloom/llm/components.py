"""Connected components of a graph of 64-bit ids, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours to the least of them and the node itself.

    With ``larger``, only neighbours above the node; else only those below it, for which
    edges are directed from the larger end to the smaller. The least neighbour comes from
    an aggregate and is joined back, so that no node's neighbours are gathered.
    """
    if larger:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = around.join(least, "a")
    if larger:
        found = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return found.filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest id that a node reaches; only nodes with an edge.

    ``edges`` has columns a and b of type bigint. Self-links and null ends are ignored,
    repeated edges count once. Each round is written to the shared folder. More than
    ``rounds`` rounds, which no graph of realistic size takes, raise an error.
    """
    edges = staged(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        edges = staged(_star(_star(edges, True), False), "edges")
        # A fixed point keeps number and sum of the edges; both only fall before it.
        state = edges.agg(
            F.count("*"),
            F.sum(F.col("a").cast("decimal(38,0)")),
            F.sum(F.col("b").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("a", "b")),
        ).first()
        if state == before:
            roots = edges.select("b").distinct().select(F.col("b").alias("a"), "b")
            return edges.unionByName(roots).select(
                F.col("a").alias("node"), F.col("b").alias("component")
            )
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
