"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerglass.sources.stage import stage


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): every node of the links (columns a, b) with the smallest node it is connected to.

    Each round hangs a node's larger neighbours, then its smaller ones, under the smallest neighbour, until
    nothing changes: the number of links never grows, and paths shorten about by half. A round's links
    are a written table, so lineage stays short. A node with many neighbours is only ever
    grouped by partial aggregation and joined with one row.
    """
    now = stage(links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    for _ in range(rounds):
        both = now.union(now.select(F.col("high"), F.col("low"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
        # Every larger neighbour goes under the node's minimum; the node itself too.
        large = both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        small = large.union(least.select(F.col("node"), F.col("least"))).where("low < high").distinct()
        # Of a node's smaller neighbours, the smallest stays; the others are linked with it.
        lowest = small.groupBy("high").agg(F.min("low").alias("least"))
        others = small.join(lowest, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        new = stage(lowest.select("high", F.col("least").alias("low")).union(others).distinct().select("low", "high"))
        settled = new.groupBy("high").agg(F.count("*").alias("n"), F.min("low").alias("low"))
        roots = settled.select("low").distinct().join(settled.select(F.col("high").alias("low")), "low", "left_semi")
        if settled.where("n > 1").isEmpty() and roots.isEmpty():
            now = new
            break
        now = new
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).union(now.select(F.col("low"), F.col("low")).distinct())
