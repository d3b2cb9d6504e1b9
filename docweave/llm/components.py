"""Connected components of a link table, by alternating stars.

The large star links every larger neighbour of a node to the smallest of its
neighbourhood, the small star every smaller neighbour and the node itself; the
number of rounds grows with the logarithm of the longest chain.  Both are a
minimum per node (pre-aggregated) and a join, so no node's neighbours are ever
gathered.  The minima are written before the join: both its sides then come
straight from a shuffle, which lets Spark split a hub's rows over tasks.  Each
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm import common

#: Rounds after which something must be wrong.
MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = common.written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = common.written(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of the nodes with links to others, for ``links`` of
    two columns: the smallest id reachable.  Nulls and links of a node with
    itself are ignored; no links, no rows."""
    a, b = links.columns
    pairs = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = common.written(pairs, "links")
    before = None
    for _ in range(MOST_ROUNDS):
        state = _digest(now)
        if state == before or not state[0]:
            break
        before = state
        now = common.written(_small_star(common.written(_large_star(now), "links")), "links")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


common.by_value(__name__)
