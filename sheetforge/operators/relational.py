"""Dedupe, differences, counts, paging and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Gaps that a task spells out, about, and the bits of a block of values in their order.
GAP_ROWS, GAP_BITS = 10_000_000, 6


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """How many partitions so many rows are dealt over, so that a task's share stays at about `each`; Spark's own number at least.

    Partitions that Spark chooses are joined again by their compressed size, which says little of the memory of repetitive rows.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


# --- one row a key


def pick(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in `order`, which has to be total for a repeatable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], *ordinal: str) -> DataFrame:
    return pick(df, keys, *[F.col(c).asc() for c in ordinal])


def last_wins(df: DataFrame, keys: list[str], *ordinal: str) -> DataFrame:
    return pick(df, keys, *[F.col(c).desc() for c in ordinal])


def latest(df: DataFrame, keys: list[str], at: str, *tie: str) -> DataFrame:
    """The newest row of each key; of equally new ones the first by `tie`."""
    return pick(df, keys, F.col(at).desc_nulls_last(), *[F.col(c).asc() for c in tie])


def titled_first(df: DataFrame, keys: list[str], title: str, *ordinal: str) -> DataFrame:
    """The first row with a title; the first row if none has one."""
    blank = F.coalesce(F.col(title), F.lit("")) == ""
    return pick(df, keys, blank.asc(), *[F.col(c).asc() for c in ordinal])


# --- sets of keys


def only_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `left` that `right` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def is_subset(part: DataFrame, whole: DataFrame, keys: list[str], name: str = "is_subset") -> DataFrame:
    """One row: whether every key of `part` is in `whole`, and how many aren't."""
    return only_left(part, whole, keys).agg((F.count("*") == 0).alias(name), F.count("*").alias("n_missing"))


def gap_runs(df: DataFrame, key: str, value: str, first: str = "first_missing", last: str = "last_missing") -> DataFrame:
    """(key, first, last): the runs of integers between each key's smallest and largest value that don't occur; one row a run.

    Repeated values need no step of their own: only the last of equal ones is followed by a larger value. So rows are moved once.
    """
    follows = F.lead(value).over(Window.partitionBy(key).orderBy(value))
    steps = df.select(key, value).where(F.col(value).isNotNull()).withColumn("_next", follows)
    return steps.where(F.col("_next") > F.col(value) + 1).select(key, (F.col(value) + 1).alias(first), (F.col("_next") - 1).alias(last))


def gaps(df: DataFrame, key: str, value: str) -> DataFrame:
    """Integers between each key's smallest and largest value that don't occur: the runs, spelled out.

    The result grows with keys times values. So that it needs little room where it is stored, a task has neighbouring keys, and its rows come block of values by
    block, key after key: one key's values follow those of the key before, which are nearly the same, and a file's encoding and compression take them together.
    Runs are sorted, rows are not. Tasks follow the number of rows, of which one sum comes to the driver.
    """
    ends = df.groupBy(key).agg((F.max(value) - F.min(value)).alias("_span"))
    tasks = tasks_for(df.sparkSession, ends.agg(F.sum("_span")).first()[0] or 0, GAP_ROWS)
    runs = gap_runs(df.select(key, value).repartitionByRange(tasks, key), key, value, "_first", "_last")
    blocks = F.sequence(F.shiftright("_first", GAP_BITS), F.shiftright("_last", GAP_BITS))
    cut = runs.select(key, "_first", "_last", F.explode(blocks).alias("_block")).sortWithinPartitions("_block", key, "_first")
    start = F.shiftleft("_block", GAP_BITS)
    return cut.select(key, F.explode(F.sequence(F.greatest("_first", start), F.least("_last", start + F.lit(2**GAP_BITS - 1)))).alias(value))


def count_diff(live: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by key on both sides and their difference, where they differ; a missing key counts as 0."""
    a = live.groupBy(*keys).agg(F.count("*").alias("live"))
    b = staged.groupBy(*keys).agg(F.count("*").alias("staged"))
    both = a.join(b, keys, "full").select(*keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("live", "staged")])
    return both.where("live != staged").withColumn("delta", F.col("staged") - F.col("live"))


def semi_by_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose column has one of the values: a filter that reaches the scan."""
    return df.where(F.col(column).isin(values))


def changed(stored: DataFrame, candidate: DataFrame, key: str, checksum: str) -> DataFrame:
    """Candidates that are new or whose checksum isn't the stored one's, with the old checksum."""
    old = stored.select(F.col(key).alias("_key"), F.col(checksum).alias(f"old_{checksum}"))
    joined = candidate.join(old, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.where(~F.col(checksum).eqNullSafe(F.col(f"old_{checksum}")))


# --- counts


def counts_by(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    """The grand total, counts by `a`, and counts by `a` and `b`, in one pass."""
    return df.groupingSets([[], [a], [a, b]], a, b).agg(F.count("*").alias(name), F.grouping_id().alias("level"))


def repeated(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def missing_histogram(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(field, n_missing) for each test that holds for some row; one scan."""
    sums = df.agg(*[F.count_if(t).alias(k) for k, t in tests.items()])
    pairs = ", ".join(f"'{k}', `{k}`" for k in tests)
    return sums.select(F.expr(f"stack({len(tests)}, {pairs}) as (field, n_missing)")).where("n_missing > 0")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    one = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, one)


def counts_with_zero(keys: DataFrame, rows: DataFrame, key: str, name: str = "n") -> DataFrame:
    """A count for every key, 0 for those without rows; counted before the join."""
    counted = rows.groupBy(key).agg(F.count("*").alias(name))
    return keys.join(counted, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def envelope(run_id: str, tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows of several tables as (run_id, table_name, slash_sheet, row_data): one shape for all."""
    out = [
        df.select(
            F.lit(run_id).alias("run_id"), F.lit(name).alias("table_name"), sheet.cast("string").alias("slash_sheet"),
            F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])).alias("row_data"),
        )
        for name, (df, sheet) in tables.items()
    ]
    return reduce(DataFrame.unionByName, out)


# --- paging


def page(df: DataFrame, order: list[Column], limit: int = 25, offset: int = 0, total: str | None = "total") -> DataFrame:
    """A page in `order`, with the number of all rows beside it; past the end one row with the total, all else null.

    The page is a top-k (no full sort) and the total an aggregate of its own, so no window gathers all rows.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be 1 to 100")
    if offset < 0:
        raise ValueError("offset must be 0 or more")
    rows = df.orderBy(*order).offset(offset).limit(limit) if offset else df.orderBy(*order).limit(limit)
    if not total:
        return rows
    counted = df.agg(F.count("*").alias(total))  # one row
    shown = rows.crossJoin(F.broadcast(counted))
    return shown.unionByName(counted.where(F.col(total) <= offset), allowMissingColumns=True) if offset else shown


# --- windows


def carry_forward(df: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """The last value that isn't null, up to this row."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def context_lines(df: DataFrame, key: str, order: list[str], line: str, name: str, n: int = 6) -> DataFrame:
    """This line and the n - 1 before it, joined by spaces."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - n, 0)
    return df.withColumn(name, F.array_join(F.collect_list(line).over(w), " "))


def look_ahead(df: DataFrame, key: str, order: list[str], value: str, name: str, n: int = 7) -> DataFrame:
    """The array of the next n values."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1, n)
    return df.withColumn(name, F.collect_list(value).over(w))


def bad_transitions(df: DataFrame, key: str, order: list[str], state: str, valid: DataFrame) -> DataFrame:
    """Rows whose step from the state before isn't in `valid` (from_state, to_state)."""
    w = Window.partitionBy(key).orderBy(*order)
    steps = df.withColumn("from_state", F.lag(state).over(w)).withColumn("to_state", F.col(state)).where("from_state is not null")
    return steps.join(F.broadcast(valid), ["from_state", "to_state"], "left_anti")
