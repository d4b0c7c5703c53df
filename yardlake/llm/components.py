"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Gives node, label; nodes of one component have one label, which is one of them.

    Contraction: each round every node takes the neighbour (or itself) of least hash, a new hash each round, and the
    graph shrinks to the nodes taken. Rounds grow with the logarithm of the longest chain; hubs are only ever
    aggregated (map-side first) or joined, which Spark can split.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links", narrow=True)
    rounds = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("node"))  # noqa: E731, B023
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("m"))
        taken = written(least.select("node", F.least(F.col("m"), rank("node"))["node"].alias("label")), "components", narrow=True)
        rounds.append(taken)
        for end in ("a", "b"):
            links = links.join(taken.select(F.col("node").alias(end), F.col("label").alias(f"{end}2")), end)
        links = links.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).where("a <> b").distinct()
        links = written(links, "links", narrow=True)
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("label"), F.col("label").alias("next"))
        out = out.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return out
