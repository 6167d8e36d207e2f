"""Connected components of an undirected graph, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _larger_first(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u long, v long)`` with a neighbour; root is its component's least node.

    Large-star and small-star rounds: each links the neighbours of a node to the least node among
    them, until every component is a star. Rounds grow with the logarithm of the longest path.
    A node's neighbours never meet in one row; the least of them is aggregated before the shuffle,
    stored and joined back. What is joined is a stored table, not an aggregate's own partitions, so
    that the adaptive planner can split the join for nodes with very many neighbours.
    Loops, repeated edges and an empty table are fine; edges with a null end are left out.
    """
    pairs = stored(_larger_first(edges.select("u", "v").dropna()))
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        pairs = stored(_larger_first(small))
        now = _state(pairs)
        if now == state:
            break
        state = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
