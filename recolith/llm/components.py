"""Connected components by contraction: every round hooks each vertex to its smallest neighbour, jumps once, and
keeps only the edges between different trees, so the number of vertices with edges at least halves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b); root is the smallest vertex of its component."""
    now = scratch.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not now.isEmpty():
        hooks = now.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p"))
        alone = now.select(F.col("a").alias("v"), F.col("a").alias("p"))
        parent = scratch.save(hooks.union(alone).groupBy("v").agg(F.min("p").alias("p")), "parents")
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
        step = scratch.save(parent.join(up, "p").select("v", F.col("q").alias("root")), "step")
        maps.append(step)
        a = step.select(F.col("v").alias("a"), F.col("root").alias("ra"))
        b = step.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        cut = now.join(a, "a").select("b", "ra").join(b, "b").filter("ra <> rb")
        now = scratch.save(cut.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if not maps:
        return now.select(F.col("a").alias("v"), F.col("a").alias("root"))
    out = maps[-1]
    for step in reversed(maps[:-1]):
        later = out.select(F.col("v").alias("root"), F.col("root").alias("last"))
        out = scratch.save(step.join(later, "root", "left").select("v", F.coalesce("last", "root").alias("root")), "roots")
    return out
