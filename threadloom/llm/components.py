"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.sources.stages import cut_lineage


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0))).first()
    return int(row[0]), int(row[1])


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``: the smallest node it can reach.

    Every round hooks the neighbours of a node to its smallest neighbour, first the
    larger ones, then the smaller ones; the tables shrink to one star per component in
    about log(n) rounds. Rounds are reliable checkpoints; counts alone reach the driver.
    Minima are combined before the shuffle and the joins are plain equi-joins, whose hot
    nodes adaptive execution can split.
    """
    edges = cut_lineage(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = cut_lineage(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        after = _signature(edges)
        if after == before == _signature(large):
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
