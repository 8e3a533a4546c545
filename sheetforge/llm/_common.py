"""Shared helpers: the shared work folder, materialised tables, global prefix sums."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A join side with at most this many narrow rows may be broadcast; more rows are joined by shuffle.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only where it is unset and Spark runs in one process
    (tests) a new local one is set; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="sheetforge-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_dir(spark: SparkSession, what: str) -> str:
    """A new path inside the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/sheetforge/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write `df` once as Parquet in the shared folder and read it back. `discard` deletes it."""
    path = work_dir(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete materialised tables that no later plan reads."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def own_columns(df: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of `df`, whatever their names, without those called `but`."""
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in {x.lower() for x in but}]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Rows in a batch that goes to Python, so that a batch of long texts stays small on both sides.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Sets Spark's rows a batch for Python to BATCH_ROWS, unless the session has a number of its own."""
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, str(BATCH_ROWS))


def map_arrow(rows: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """mapInArrow for columns of any names, also with dots: Spark sees numbered ones."""
    bounded_batches(rows.sparkSession)
    names, outs = rows.columns, [f"c{i}" for i in range(len(schema))]

    def renamed(batches):
        for out in run(b.rename_columns(names) for b in batches):
            yield out.rename_columns(outs)

    plain = StructType([StructField(o, f.dataType) for o, f in zip(outs, schema, strict=True)])
    return rows.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, plain).toDF(*schema.names)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has `limit` rows at most, else unchanged (a shuffle join follows)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Rows of one value that are joined with one copy of its partner.
PER_COPY = 512


def hot_values(rows: DataFrame, column: str, per_copy: int = PER_COPY) -> DataFrame:
    """(`column`, copies) of the values that more than `per_copy` rows have, for `dealt` and `copied`."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > per_copy)
    return small_side(materialize(counts.select(column, F.expr(f"cast((n + {per_copy - 1}) div {per_copy} as int)").alias("copies")), "hot"))


def dealt(rows: DataFrame, column: str, hot: DataFrame, by: list[str]) -> DataFrame:
    """`rows` with the column `copy`: those of a hot value are dealt over its copies by a hash of the columns `by`.

    With the other side `copied`, a join on (`column`, copy) has no hot key.
    """
    own = F.pmod(F.xxhash64(*by), F.coalesce("copies", F.lit(1))).cast("int")
    return rows.join(hot, column, "left").withColumn("copy", own).drop("copies")


def copied(rows: DataFrame, column: str, hot: DataFrame) -> DataFrame:
    """`rows` with the column `copy`: each row once, or once for each copy that `hot` gives its `column`."""
    every = F.explode(F.expr("sequence(0, coalesce(copies, 1) - 1)"))
    return rows.join(hot, column, "left").withColumn("copy", every).drop("copies")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, order: list[Column], measures: dict[str, str]) -> DataFrame:
    """Global row index and exclusive prefix sums in the order of `order`, without a global window.

    Rows are range-partitioned and written once; each partition's totals (one row a partition, so a
    bounded table) are accumulated and broadcast back; the rest is a running sum inside each partition.
    Adds `idx` (from 0), and for each `measures[name] = column` the sum of that column over all rows
    before (`name`) and over all rows (`name_total`).
    """
    spark = df.sparkSession
    keyed = materialize(
        df.repartitionByRange(shuffle_partitions(spark), *order).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    sums = {name: F.sum(col).alias(name) for name, col in measures.items()}
    totals = keyed.groupBy("_part").agg(F.count("*").alias("_n"), *sums.values())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base_n"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_base_{m}") for m in measures],
        *[F.sum(m).over(everything).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(F.broadcast(base), "_part")
    return out.select(
        *[F.col(c) for c in df.columns],
        (F.col("_base_n") + F.row_number().over(inside) - 1).alias("idx"),
        *[
            (F.col(f"_base_{m}") + F.coalesce(F.sum(c).over(earlier), F.lit(0))).alias(m)
            for m, c in measures.items()
        ],
        *[F.col(f"{m}_total") for m in measures],
    )
