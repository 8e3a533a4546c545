"""Streams: monotonic upserts, tumbling and session windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.log import KeyedTable


def read_events(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def tumbling(events: DataFrame, at: str = "ts", key: str = "event_type", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window; rows later than the watermark are dropped, state stays bounded."""
    w = F.window(F.col(at).cast("timestamp"), width)
    marked = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return marked.groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "w.end", key, "n", "total")


def sessions(events: DataFrame, at: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    marked = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    s = F.session_window(F.col(at), gap)
    return marked.groupBy(s.alias("s"), key).agg(F.count("*").alias("n")).select("s.start", "s.end", key, "n")


def upsert_not_older(path: str, key: str, at: str, tie: str, buckets: int = 64):
    """A foreachBatch function: keeps the newest row of each key in a `KeyedTable` at `path`; older arrivals change nothing.

    A batch writes its own rows to the buckets that they touch, not the table. One that is run again after a restart is known by its number and left out.
    `current` reads the table.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, path, batch.schema, key, at, tie, buckets).add(batch, batch_id)

    return run


def current(spark: SparkSession, path: str, schema: StructType, key: str, at: str, tie: str) -> DataFrame:
    """The newest row of each key of a table that `upsert_not_older` keeps."""
    return KeyedTable(spark, path, schema, key, at, tie).read()


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes in all that is there and appends what comes out as Parquet; a later call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
