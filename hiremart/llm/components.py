"""Connected components of an edge list by star contraction.

Every round hangs the larger neighbours of each node, and then all its smaller
ones, to the least node near it; the edges become stars around the least node
of each component in a number of rounds that grows with the logarithm of its
size.  Each round is written to the shared folder, in files by its number of edges; the driver sees two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.common import discard, salted_left_join, written


EDGE_BYTES = 16


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = salted_left_join(both.where("v > u"), least, ["u"], F.col("v"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = salted_left_join(down, least, ["u"], F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and comp (the least node of its component) of every node that has an edge."""
    now = written(_small_star(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "components", 2 * EDGE_BYTES * edges.count())
    state, n = None, now.count()
    while True:
        before, now = now, written(_small_star(_large_star(now)), "components", 2 * EDGE_BYTES * n)
        discard(before)
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == state:
            break
        state, n = sums, sums[0]
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )
