"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, passing


def _least(edges: DataFrame) -> DataFrame:
    """a and m, its smallest neighbour; as a table of its own, so that Spark can split a join with it where one ``a`` has most of the edges."""
    return cut(edges.groupBy("a").agg(F.min("b").alias("m")), "cc-least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "cc-down")
    least = _least(down)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b of one orderable type, a <> b).

    Each round is a few joins and map-side minima; no node's neighbours are gathered. Rounds end when the
    edges no longer change, about log2 of the longest path. Tables of a round are removed when the next one is written.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct(), "cc")
    before = None
    for _ in range(most_rounds):
        with passing(edges.sparkSession) as old:
            old.append(edges)
            edges = cut(_small_star(_large_star(edges)), "cc", keep=True)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
