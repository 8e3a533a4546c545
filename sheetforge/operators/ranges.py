"""Joins of numbers with the ranges that hold them, without comparing every number with every range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges so few are better broadcast.
FEW = 64
_LEVELS = 62


def dyadic(lo: Column, hi: Column) -> Column:
    """array<struct<level int, node long>>: the blocks [node * 2**level, (node + 1) * 2**level) that together are the integers lo to hi.

    At most two blocks a level, so a range of n integers has 2 * log2(n) at most. Empty if lo > hi or either is null.
    """
    none = F.array().cast("array<struct<level:int,node:bigint>>")
    start = F.struct(lo.cast("long").alias("l"), (hi.cast("long") + 1).alias("r"), none.alias("nodes"))

    def up(state: Column, level: Column) -> Column:
        left, right, live = state["l"], state["r"], state["l"] < state["r"]
        odd_left = live & (left.bitwiseAND(F.lit(1)) == 1)
        odd_right = live & (right.bitwiseAND(F.lit(1)) == 1)
        block = lambda node: F.array(F.struct(level.cast("int").alias("level"), node.alias("node")))
        nodes = F.when(odd_left, F.concat(state["nodes"], block(left))).otherwise(state["nodes"])
        nodes = F.when(odd_right, F.concat(nodes, block(right - 1))).otherwise(nodes)
        after, before = F.when(odd_left, left + 1).otherwise(left), F.when(odd_right, right - 1).otherwise(right)
        return F.struct(F.shiftright(after, 1).alias("l"), F.shiftright(before, 1).alias("r"), nodes.alias("nodes"))

    found = F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS)), start, up, lambda s: s["nodes"])
    return F.when(lo.isNull() | hi.isNull() | (lo > hi), none).otherwise(found)


def in_ranges(points: DataFrame, ranges: DataFrame, number: str, lo: str = "lo", hi: str = "hi", unit: float = 1, how: str = "inner") -> DataFrame:
    """Each row of `points` with every row of `ranges` that holds its number (both ends included); a row for each that overlaps.

    Ranges are cut into blocks of 2**level units, `unit` wide at level 0, and a number looks its own block up at each level that occurs: an equal-key join whose
    hot keys Spark can split, on which the ends are compared. A number meets a range once, as a range's blocks are apart. Null numbers and ranges with a null end,
    or with lo above hi, match nothing. With how = "left" points without a range stay, with nulls. Column names of the two sides must differ.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    cell = lambda c: F.floor(F.col(c) / F.lit(unit)).cast("long") if unit != 1 else F.floor(c).cast("long")
    cut = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_b", F.explode(dyadic(cell(lo), cell(hi))))
    cut = cut.select(*ranges.columns, F.col("_b.level").alias("_level"), F.col("_b.node").alias("_node"))
    levels = sorted(r["_level"] for r in cut.select("_level").distinct().collect())  # 63 at most
    own = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(cell(number), k).alias("node")) for k in levels] or [F.struct(F.lit(-1).alias("level"), F.lit(0).cast("long").alias("node"))]))
    asked = points.where(F.col(number).isNotNull()).withColumn("_b", own).select(*points.columns, F.col("_b.level").alias("_level"), F.col("_b.node").alias("_node"))
    met = asked.join(cut, ["_level", "_node"]).where(F.col(number).between(F.col(lo), F.col(hi))).drop("_level", "_node")
    if how == "inner":
        return met
    lonely = points.join(met.select(number).distinct(), number, "left_anti").select(*points.columns)
    return met.unionByName(lonely, allowMissingColumns=True)
