"""Connected components of an edge table, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.runtime import materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours are linked to its least one instead."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialize(least, "star-least").df  # a table, so that the join below can be split at a hot node
    return both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are linked to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "star-least").df
    moved = down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(``node``, ``root``) for every node that an edge names; ``root`` is the
    least node of its component.

    ``edges`` has two columns of longs; loops, repeats and null ends do no
    harm. Large and small stars alternate until the edges stay the same; each
    round is written to the checkpoint folder, which cuts the lineage.
    """
    ends = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    state = lambda t: tuple(t.df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_003), F.lit(0)), F.coalesce(F.sum(F.xxhash64("v", "u") % 1_000_033), F.lit(0))).first())
    now = materialize(ends.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star-edges")
    before = state(now)
    while before[0]:
        now = materialize(small_star(large_star(now.df)), "star-edges")
        after = state(now)
        if after == before:
            break
        before = after
    named = now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.df.select("v", "v"))
    return named.union(ends.filter("u = v").select("u", "v")).groupBy("node").agg(F.min("root").alias("root"))
