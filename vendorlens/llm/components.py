"""Connected components of a graph given as edges, on Spark.

Alternating large-star and small-star steps: each step is an aggregate and a
join over the edges, and the result of each round is a table in the shared
folder. No edge list reaches the driver, only a count and a checksum per
round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Add ``least``: the smallest b of every a."""
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) between comparable ids to (node, root): for every
    node of an edge that is not the smallest of its component, the smallest.
    Loops and repeated edges do no harm."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while state != (state := _state(now)):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = _with_least(both).where("b > a").select(
            F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        # small star: smaller neighbours, and the node, move to the smallest of them
        small = _with_least(large).select(F.explode(F.array(
            F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        after = stored(small)
        discard(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
