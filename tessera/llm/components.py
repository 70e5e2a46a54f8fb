"""Connected components of an edge table by alternating large-star and small-star steps: no driver state, no unbounded group in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch


def _star(both: DataFrame, larger: bool) -> DataFrame:
    """Links each chosen neighbour of u to the least of u and its neighbours. The minimum is a partial aggregate that is joined back, so a hub's links are never gathered."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    side = F.col("v") > F.col("u") if larger else F.col("v") <= F.col("u")
    linked = both.where(side).join(least, "u")
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, label: str, rounds: int = 60) -> DataFrame:
    """(id, component): the least id reachable from each id that has an edge. `edges`: columns a and b."""
    current = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-0")
    before = None
    for k in range(1, rounds + 1):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        wide = _star(both, larger=True)
        down = wide.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        current = scratch.keep(_star(down, larger=False), f"{label}-{k}")
        mark = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"{label}-{k - 1}")
        if mark == before or not mark[0]:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    pairs = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return scratch.keep(pairs.union(pairs.select("component", "component")).distinct(), f"{label}-labels")
