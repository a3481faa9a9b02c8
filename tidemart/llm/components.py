"""Connected components of a table of links, each named by its smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import pin

#: Each round about halves the length of every chain; a table that needs more rounds is refused, not cut short.
ROUNDS = 64


def _stars(pairs: DataFrame) -> DataFrame:
    """Links between a node and the least of its neighbourhood, as (node, least) with least < node.

    The first star joins larger neighbours to a node's least neighbour, the
    second joins a node and its smaller neighbours to the least of these. Each
    is a minimum by node, combined before the shuffle, joined to the links, so
    that no node's neighbours are ever collected.
    """
    both = pairs.select("node", "least").union(pairs.select(F.col("least").alias("node"), F.col("node").alias("least")))
    around = both.groupBy("node").agg(F.least(F.min("least"), F.col("node")).alias("to"))
    larger = both.filter("least > node").join(around, "node").select(F.col("least").alias("node"), F.col("to").alias("least"))
    larger = larger.distinct()
    below = larger.groupBy("node").agg(F.min("least").alias("to"))
    joined = larger.join(below, "node")
    moved = joined.select(F.col("least").alias("node"), F.col("to").alias("least"))
    return moved.union(below.select("node", F.col("to").alias("least"))).filter("least < node").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` for each node of ``links`` (columns a, b) that is not its component's smallest.

    Nodes that are missing from the result are their own component's smallest.
    Links may repeat, lead either way, or lead from a node to itself. Each
    round is written to the shared folder and read back.
    """
    pairs = links.select(F.greatest("a", "b").cast("long").alias("node"), F.least("a", "b").cast("long").alias("least"))
    pairs = pin(pairs.filter("least < node").distinct(), "links")
    check = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "least").cast("decimal(38,0)")).alias("h"))
    before = pairs.select(check.alias("c")).first().c
    for _ in range(ROUNDS):
        pairs = pin(_stars(pairs), "stars")
        now = pairs.select(check.alias("c")).first().c
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links were still moving after {ROUNDS} rounds")
    return pairs.select("node", F.col("least").alias("component"))
