"""Differences of two large tables by checksums of key ranges in a tree: only ranges whose sums differ are compared by row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys in a leaf, and nodes of one level in a node of the next.
LEAF, FAN = 1024, 32
#: Differing leaves up to this number become ranges in the scan's filter; more are joined.
RANGES = 500


@dataclass(frozen=True)
class Shape:
    """A tree over an integer key, which must not be null; `levels` above the leaves."""

    key: str
    leaf: int = LEAF
    fan: int = FAN
    levels: int = 3

    def node(self, level: int) -> Column:
        """The node that a row is in."""
        return _floor_div(f"`{self.key}`", self.leaf * self.fan**level)

    def above(self, level: int) -> Column:
        """The node of the next level that a node of a table of sums is in."""
        return _floor_div("node", self.fan)


def _floor_div(number: str, by: int) -> Column:
    """Whole-number division that rounds down, exact for every long."""
    return F.expr(f"(cast({number} as bigint) - pmod(cast({number} as bigint), {by}L)) div {by}L")


def _row_hash(df: DataFrame) -> Column:
    """A number for a whole row, from its columns in the order of their names; a null is told from any value."""
    names = sorted(df.columns)
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in names])


def checksums(df: DataFrame, shape: Shape) -> DataFrame:
    """(level, node, n, total) of every node that has rows: the number of rows and the sum of their hashes, which no order changes.

    The leaves are counted in one pass; a level follows from the one below. Stored beside a snapshot, they spare reading it again.
    """
    hashed = F.sum(_row_hash(df).cast("decimal(38,0)")).alias("total")
    leaves = df.groupBy(shape.node(0).alias("node")).agg(F.count("*").alias("n"), hashed)
    out = level = leaves.select(F.lit(0).alias("level"), "node", "n", F.col("total").cast("decimal(38,0)").alias("total"))
    for k in range(1, shape.levels + 1):
        level = level.groupBy(shape.above(k - 1).alias("node")).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
        level = level.select(F.lit(k).alias("level"), "node", "n", "total")
        out = out.unionByName(level)
    return out


def differing_leaves(a: DataFrame, b: DataFrame, shape: Shape) -> DataFrame:
    """(node) of the leaves whose sums differ: from the top down, only below nodes that differ. a, b: `checksums` of two tables."""
    parents = None
    for k in range(shape.levels, -1, -1):
        sides = []
        for t in (a, b):
            rows = t.where(F.col("level") == k)
            if parents is not None:
                rows = rows.withColumn("above", shape.above(k)).join(parents, "above", "left_semi")
            sides.append(rows.select("node", "n", "total"))
        left, right = sides[0], sides[1].select("node", F.col("n").alias("m"), F.col("total").alias("other"))
        found = left.join(right, "node", "full").where(~F.col("n").eqNullSafe(F.col("m")) | ~F.col("total").eqNullSafe(F.col("other")))
        parents = found.select(F.col("node").alias("above"))
    return parents.withColumnRenamed("above", "node")


def _rows_of(df: DataFrame, shape: Shape, leaves: DataFrame, listed: list[int] | None) -> DataFrame:
    if listed is None:
        return df.withColumn("_node", shape.node(0)).join(leaves.withColumnRenamed("node", "_node"), "_node", "left_semi").drop("_node")
    runs: list[list[int]] = []
    for x in sorted(listed):
        if runs and runs[-1][1] == x:
            runs[-1][1] = x + 1
        else:
            runs.append([x, x + 1])
    inside = F.lit(False)
    for lo, hi in runs:
        inside = inside | ((F.col(shape.key) >= lo * shape.leaf) & (F.col(shape.key) < hi * shape.leaf))
    return df.where(inside)


def tree_diff(a: DataFrame, b: DataFrame, shape: Shape, sums_a: DataFrame | None = None, sums_b: DataFrame | None = None) -> DataFrame:
    """(key, kind): keys whose rows were `added` in b, `lost` from a, or `changed`, by all columns; both tables have the same.

    With stored sums, rows are read only in the leaves that differ: as ranges of the key in the scan's filter if they are few, else by a
    semi join. A key may have several rows: they count as changed if the rows of both sides aren't the same, in any order.
    """
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError("the tables have different columns")
    leaves = differing_leaves(sums_a if sums_a is not None else checksums(a, shape), sums_b if sums_b is not None else checksums(b, shape), shape)
    few = [r["node"] for r in leaves.limit(RANGES + 1).collect()]
    listed = few if len(few) <= RANGES else None

    def by_key(df: DataFrame, n: str, total: str) -> DataFrame:
        rows = _rows_of(df, shape, leaves, listed)
        return rows.groupBy(shape.key).agg(F.count("*").alias(n), F.sum(_row_hash(df).cast("decimal(38,0)")).alias(total))

    both = by_key(a, "n", "total").join(by_key(b, "m", "other"), shape.key, "full")
    kind = F.when(F.col("n").isNull(), "added").when(F.col("m").isNull(), "lost").when((F.col("n") != F.col("m")) | (F.col("total") != F.col("other")), "changed")
    return both.select(F.col(shape.key).alias("key"), kind.alias("kind")).where("kind is not null")
