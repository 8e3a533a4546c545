"""A store of files under one folder. Changes are a plan first, a row for each file; executors carry it out.

Files go from place to place in blocks and never through the driver. Every step can be done twice: what is replaced is archived before,
a file gets its name when it is whole, and a source goes only after its copy is there.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t

BLOCK = 1 << 20
PLAN = ("action", "path", "source", "archive", "checksum", "old_checksum")


def opened(place: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a URI or a local path."""
    if place.startswith("file:") and not place.startswith("file://"):
        place = "file://" + place[len("file:") :]
    if place.startswith("file://"):
        return fs.LocalFileSystem(), place[len("file://") :]
    return fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)


def stored(spark: SparkSession, root: str) -> DataFrame:
    """(path, n_bytes, checksum) of the store's files, paths below its root; parts of unfinished files aren't listed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.substr("path", F.lit(len(base) + 2)).alias("path"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("checksum"))


def _planned(df: DataFrame, action: Column, archive: Column) -> DataFrame:
    return df.withColumn("action", action).withColumn("archive", archive).select(*PLAN)


def _asked_once(df: DataFrame) -> DataFrame:
    """Adds whether several different files ask for a row's path."""
    n = df.groupBy("path").agg((F.min("checksum") != F.max("checksum")).alias("_several"))
    return df.join(n, "path")


def upload_plan(arriving: DataFrame, stored: DataFrame) -> DataFrame:
    """A plan for files (path, source, checksum) that arrive: `add`, `keep` where the store has the same bytes, `replace`
    with the place where the old bytes are archived, and `conflict` where different files ask for one path (none is taken).
    Rows without path, source or checksum are `missing`; of equal files for one path the smallest source counts."""
    one = arriving.groupBy("path", "checksum").agg(F.min("source").alias("source"))
    rows = _asked_once(one.where("path is not null and checksum is not null and source is not null"))
    j = rows.join(stored.select("path", F.col("checksum").alias("old_checksum")), "path", "left")
    action = F.when(F.col("_several"), "conflict").when(F.col("old_checksum").isNull(), "add").when(F.col("old_checksum") == F.col("checksum"), "keep").otherwise("replace")
    gone = one.where("path is null or checksum is null or source is null").withColumn("old_checksum", F.lit(None).cast("string"))
    archive = F.when(F.col("action") == "replace", t.archive_path("path", "old_checksum"))
    return _planned(j, action, archive).unionByName(_planned(gone, F.lit("missing"), F.lit(None).cast("string")))


def move_plan(docs: DataFrame, actual: str, desired: str, stored: DataFrame) -> DataFrame:
    """A plan for documents whose file isn't at the place they ask for: `move`, `missing` where there is no file, and
    `conflict` where another file is there or asks for it too, or one file is asked to two places. `source` is the path
    below the root. A chain of moves takes a plan for each of its links."""
    rows = docs.select(F.col(actual).alias("source"), F.col(desired).alias("path")).where("path is not null and not source <=> path").distinct()
    forks = rows.groupBy("source").agg((F.count("*") > 1).alias("_forked"))
    rows = rows.join(forks, "source", "left")
    found = rows.join(stored.select(F.col("path").alias("source"), "checksum"), "source", "left")
    there = stored.select("path", F.col("checksum").alias("old_checksum"))
    j = _asked_once(found).join(there, "path", "left")
    taken = F.col("_forked") | F.coalesce("_several", F.lit(False)) | F.coalesce(F.col("old_checksum") != F.col("checksum"), F.lit(False))
    action = F.when(F.col("checksum").isNull(), "missing").when(taken, "conflict").otherwise("move")
    return _planned(j, action, F.lit(None).cast("string"))


#: Files that another move's file takes the place of wait here; Spark doesn't list folders that begin like this.
PARKED = "_moving"


def dependent_move_plan(docs: DataFrame, actual: str, desired: str, stored: DataFrame, work: str) -> DataFrame:
    """As `move_plan`, for moves that wait for each other: chains, swaps and longer cycles are carried out by one `apply_moves`.

    A file whose place another move wants is `park`ed: it goes to a place of its own first (`archive`), so that every target is free when files go to their places,
    however long the chain. A place stays taken if its file doesn't move, and what waits for it, near or far, is a `conflict` too: that is followed by
    doubling pointers over narrow tables in the folder `work`.
    """
    spark = docs.sparkSession
    plan = move_plan(docs, actual, desired, stored)
    forked = plan.groupBy("source").agg((F.count("*") > 1).alias("_forked"))
    asked = plan.groupBy("path").agg((F.min("checksum") != F.max("checksum")).alias("_several"), (F.count("*") > 1).alias("_shared"))
    rows = plan.join(forked, "source").join(asked, "path")
    # what may move, if its target is or becomes free; of equal files for one path all may
    sound = F.col("checksum").isNotNull() & ~F.col("_forked") & ~F.coalesce("_several", F.lit(False))
    rows = rows.withColumn("_sound", sound)
    taken = rows.where(F.col("_sound") & F.col("old_checksum").isNotNull() & (F.col("old_checksum") != F.col("checksum"))).select("source", F.col("path").alias("next"))
    movers = rows.where("_sound").select(F.col("source").alias("next"), F.lit(True).alias("moves"))
    links = taken.join(movers, "next", "left").select("source", F.when(F.col("moves"), F.col("next")).alias("next"), F.col("moves").isNull().alias("blocked"))
    path = f"{work.rstrip('/')}/waiting-{uuid.uuid4().hex}"
    links.write.parquet(f"{path}/0")
    links = spark.read.parquet(f"{path}/0")
    for i in range(1, max(2, links.count().bit_length() + 2)):
        far = links.select(F.col("source").alias("next"), F.col("next").alias("_far"), F.col("blocked").alias("_stuck"))
        links.join(far, "next", "left").select("source", F.col("_far").alias("next"), (F.col("blocked") | F.coalesce("_stuck", F.lit(False))).alias("blocked")).write.parquet(f"{path}/{i}")
        links = spark.read.parquet(f"{path}/{i}")
        if links.where("next is not null").isEmpty():
            break
    free = rows.join(links.select("source", "blocked"), "source", "left")
    action = F.when(F.col("checksum").isNull(), "missing").when(~F.col("_sound") | F.coalesce("blocked", F.lit(False)), "conflict").otherwise("move")
    free = free.withColumn("action", action)
    wanted = free.where("action = 'move'").select(F.col("path").alias("source"), F.lit(True).alias("_wanted")).distinct()
    place = F.concat(F.lit(f"{PARKED}/"), F.substr(F.sha2(F.concat_ws("\n", "source", "path"), 256), F.lit(1), F.lit(24)))
    out = free.join(wanted, "source", "left").withColumn("action", F.when((F.col("action") == "move") & F.col("_wanted"), "park").otherwise(F.col("action")))
    # no bytes are in the way when files go to their places, so nothing old is named
    return out.withColumn("archive", F.when(F.col("action") == "park", place)).withColumn("old_checksum", F.lit(None).cast("string")).select(*PLAN)


def apply_moves(plan: DataFrame, root: str, report: str, apply: bool = False) -> DataFrame:
    """Carries out a `dependent_move_plan`: all parked files first, then every file to its place. It can be done again after a cut at any point."""
    if not apply:
        return apply_plan(plan, root, report)
    apply_plan(plan.where("action = 'park'"), root, f"{report}/parked", True).count()
    return apply_plan(plan.withColumn("action", F.when(F.col("action") == "park", "unpark").otherwise(F.col("action"))), root, f"{report}/moved", True)


def remove_plan(paths: DataFrame, stored: DataFrame) -> DataFrame:
    """A plan that removes paths: `remove`, or `missing`."""
    rows = paths.select("path").where("path is not null").distinct()
    j = rows.join(stored.select("path", "checksum"), "path", "left").withColumn("source", F.lit(None).cast("string")).withColumn("old_checksum", F.col("checksum"))
    return _planned(j, F.when(F.col("checksum").isNull(), "missing").otherwise("remove"), F.lit(None).cast("string"))


def _sum(place: str) -> str | None:
    system, path = opened(place)
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    found = hashlib.sha256()
    with system.open_input_stream(path) as f:
        while block := f.read(BLOCK):
            found.update(block)
    return found.hexdigest()


def put(place: str, blocks: Iterator[bytes]) -> str:
    """Writes a file and gives it its name when it is whole; returns its SHA-256."""
    system, path = opened(place)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    part, found = f"{folder}/_{uuid.uuid4().hex}.{name}.part", hashlib.sha256()
    with system.open_output_stream(part, compression=None) as f:
        for block in blocks:
            found.update(block)
            f.write(block)
    try:
        system.move(part, path)
    except OSError:  # a file system that doesn't rename over a file
        if system.get_file_info(path).type == fs.FileType.File:
            system.delete_file(path)
        system.move(part, path)
    return found.hexdigest()


def _blocks(place: str) -> Iterator[bytes]:
    system, path = opened(place)
    with system.open_input_stream(path) as f:
        while block := f.read(BLOCK):
            yield block


def _copied(source: str, target: str, checksum: str) -> bool:
    """Whether `target` has the bytes with this checksum, after a copy if it didn't."""
    return _sum(target) == checksum or (_sum(source) == checksum and put(target, _blocks(source)) == checksum)


def _delete(place: str) -> None:
    system, path = opened(place)
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


def _carried_out(root: str, action: str, path: str, source: str | None, archive: str | None, checksum: str | None, old: str | None) -> str:
    at = lambda p: f"{root}/{p}"
    if action in ("add", "replace"):
        now = _sum(at(path))
        if now == checksum:
            return "done"
        if now not in (None, old) or (action == "replace" and not _copied(at(path), at(archive), old)):
            return "changed since"  # nothing is overwritten but what the plan saw and the archive has
        return "done" if _copied(source, at(path), checksum) else "source changed"
    if action == "move":
        if _sum(at(path)) not in (None, checksum):
            return "changed since"
        if not _copied(at(source), at(path), checksum):
            return "source changed"
        if _sum(at(source)) == checksum:
            _delete(at(source))
        return "done"
    if action == "park":
        if _sum(at(path)) != checksum and not _copied(at(source), at(archive), checksum):
            return "source changed"
        if _sum(at(archive)) == checksum and _sum(at(source)) == checksum:
            _delete(at(source))
        return "done"
    if action == "unpark":
        if _sum(at(path)) not in (None, checksum):
            return "changed since"
        if not _copied(at(archive), at(path), checksum):
            return "source changed"
        _delete(at(archive))
        return "done"
    if action == "remove":
        if _sum(at(path)) not in (None, old):
            return "changed since"
        _delete(at(path))
        return "done"
    return "skipped"


def apply_plan(plan: DataFrame, root: str, report: str, apply: bool = False) -> DataFrame:
    """The plan with an `outcome` for each row; nothing is done without `apply` (outcome `planned`).

    With `apply` the outcomes are written once, as JSON, to the new folder `report` and read from there, so that looking at
    them does nothing again. A row whose files changed since the plan was made isn't carried out, and says so.
    """
    if not apply:
        return plan.withColumn("outcome", F.lit("planned"))
    root = root.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [[None if pd.isna(x) else x for x in row] for row in batch[list(PLAN)].itertuples(index=False)]
            yield batch.assign(outcome=[_carried_out(root, *row) for row in rows])

    spark = plan.sparkSession
    schema = ", ".join(f"{c} string" for c in (*PLAN, "outcome"))
    write_report(plan.select(*PLAN).repartition("path").mapInPandas(run, schema), report)
    return spark.read.schema(schema).json(report)


def write_report(rows: DataFrame, folder: str) -> None:
    """A report: a JSON object a row in a folder of its own; an older report is never overwritten."""
    rows.write.mode("errorifexists").option("ignoreNullFields", False).json(folder)
