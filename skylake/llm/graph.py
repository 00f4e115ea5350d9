"""Connected components of a graph that is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylake.llm.common import settle_counted

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of one orderable type to (node, component): the smallest node that is reachable.

    Alternates large-star and small-star steps (each node's neighbours are tied to the smallest one
    around it) until the edges no longer change, about log2 of the longest path times. Each step groups and
    joins on nodes; minima are pre-aggregated in the map tasks and a hot node's rows are split by adaptive
    skew joins. Every round is written to the shared folder, so lineage stays short. Loops and repeated
    edges do no harm; edges with a null end are ignored. Only nodes that have an edge are returned.
    """
    clean = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    now, seen = _settled(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    for _ in range(MAX_ROUNDS):
        if not seen["n"]:
            break
        now, after = _settled(_small_star(_large_star(now)))
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _settled(edges: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    mark = F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("bigint"))
    return settle_counted(edges.distinct(), "edges", mark=mark)


def _star(neighbours: DataFrame, least: DataFrame, keep: str) -> DataFrame:
    found = neighbours.join(least, "u").where(keep)
    return found.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    return _star(both, least, "v > u").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    rest = _star(down, least, "v <> least")
    own = least.select("u", F.col("least").alias("v"))
    return rest.union(own).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
