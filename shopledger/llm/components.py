"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved


def components(edges: DataFrame) -> DataFrame:
    """`edges`: two columns of one type. Returns node, component (its smallest node).

    Contraction in random order: each round every node goes to whichever of itself and its neighbours has the smallest hash,
    another hash each round, and edges between the images remain. The number of nodes falls by a constant factor however
    long the paths are, and a hub costs one row per task before each shuffle. Every round is written to the shared folder,
    with where each node has got to, so that no plan grows with the number of rounds.
    Loops and null ends are ignored; repeated edges count once; no edges give an empty result.
    """
    a, b = edges.columns[:2]
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = saved(left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    found = left.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    turn = 0
    while not left.isEmpty():
        def order(name: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("h"), F.col(name).alias("n"))

        least = left.groupBy("a").agg(F.min(order("b")).alias("other"))
        step = saved(least.select("a", F.least("other", order("a"))["n"].alias("to")))
        found = saved(
            found.join(step.select("a", F.col("to").alias("next")), F.col("root") == F.col("a"), "left")
            .select("node", F.coalesce("next", "root").alias("root"))
        )
        moved = (
            left.join(step, "a").select(F.col("to").alias("x"), "b")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        )
        left = saved(moved.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        turn += 1
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(smallest, "root").select("node", "component")
