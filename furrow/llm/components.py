"""Connected components of an edge table, by alternating star contractions.

Each round sends every node to its smallest neighbour (large star), then every
node and its smaller neighbours to the smallest of them (small star). The edge
table shrinks to one star for each component, in about log(n) rounds. Joins
and aggregations only; nothing but two counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges(u, v)`` of longs, any direction, repeats and self-loops allowed.

    Returns ``(node, component)`` for every node that has an edge to another;
    ``component`` is the smallest node reachable. Rows with a null end are ignored.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = scratch.write(now, "edges0")
    mark, step = _mark(now), 0
    while True:
        step += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        now = scratch.write(small, f"edges{step}")
        scratch.drop(f"edges{step - 1}")
        after = _mark(now)
        if after == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = after


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
