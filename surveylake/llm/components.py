"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.session import ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
    return both.filter("v > u").join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller end
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v")))


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every end of ``edges`` (u, v: long, not null), root
    being the smallest node of its component.

    Each round hangs every node's larger neighbours below its smallest one and
    then does the same to the smaller neighbours, so long chains shrink
    geometrically.  No node's neighbours are ever collected: the steps are a
    pre-aggregated minimum and a join that AQE may split at a hub.  Every round
    is checkpointed in the shared folder.  An empty table gives an empty one.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now = (edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .distinct().checkpoint())
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = _small_star(_large_star(now).distinct()).distinct().checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
