"""Connected components of an edge table by alternating large and small stars.

Each round is a few joins and aggregations over the edges; the edges of a round are
written to the shared checkpoint folder, so the plan stays short and a lost executor
reads files again. Nothing but one count and one checksum per round reaches the driver.
The edges of a round lie in as many partitions as their count needs, however many the
session's shuffles have; a few edges are one partition and a round on them one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import parts_for, written


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(parts)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (long columns u, v) -> (node, component) for every node of an edge; the
    component is its smallest node. Self-loops and repeated edges do no harm."""
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    parts, seen = parts_for(edges.count()), None
    for _ in range(max_rounds):
        edges = written(_small_star(_large_star(edges, parts), parts).coalesce(parts), "edges")
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        parts, seen = parts_for(now[0]), now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    edges = edges.coalesce(parts)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
