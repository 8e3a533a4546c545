"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import PER_COPY, copied, dealt, discard, materialize, small_side


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex moves to the smallest vertex around it; edges may repeat. edges: u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = materialize(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "around")
    hot = small_side(around.where(F.col("n") > PER_COPY).select("u", F.expr(f"cast((n + {PER_COPY - 1}) div {PER_COPY} as int)").alias("copies")))
    least = copied(around.select("u", F.least("u", "m").alias("m")), "u", hot)
    return dealt(both.where("v > u"), "u", hot, ["v"]).join(least, ["u", "copy"]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours move to the smallest of these. edges: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of `edges` (columns a, b) that isn't the smallest of its component.

    component is the smallest vertex reachable. Edges stay distributed; each step is written to the shared
    folder, and only two numbers (count and checksum of the edges) come to the driver.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = old = None
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        if old is not None:
            discard(old)
        old = now
        mark = now.agg(F.count("*"), F.sum(F.expr("xxhash64(u, v) div 4294967296"))).first()
        if mark == before:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        before = mark
