"""A log of small JSON entries, one file a number, and tables that become visible by an entry.

An entry is made by creating its file exclusively, so of several writers that want the same number exactly one gets it. Data
are written to folders of their own first and are read only where an entry names them: what a lost task, a failed job or a
writer that came too late has left is never read.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.relational import pick


class Taken(RuntimeError):
    """Another writer has made the entry."""


def local_path(path: str) -> str | None:
    """The path of a local file, or None if a store holds it."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else path
    return None


@dataclass(frozen=True)
class Log:
    """Entries 1, 2, ... under `folder`, as files named by their number."""

    spark: SparkSession
    folder: str

    def _fs(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def numbers(self) -> list[int]:
        """Numbers of the entries, in order; a file a commit, so the list is short."""
        fs, path = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict | None:
        """An entry; None for one whose writer died between creating and writing it."""
        fs, path = self._fs(f"{number:020d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("\n") else None

    def last(self) -> tuple[int, dict | None]:
        """(number of the last file, the last whole entry)."""
        numbers = self.numbers()
        for n in reversed(numbers):
            if (entry := self.read(n)) is not None:
                return numbers[-1], entry
        return (numbers[-1] if numbers else 0), None

    def append(self, after: int, entry: dict) -> int:
        """Makes entry after + 1, or raises Taken."""
        number, data = after + 1, (json.dumps(entry, sort_keys=True, default=str) + "\n").encode()
        name = f"{number:020d}.json"
        if (folder := local_path(self.folder)) is not None:  # a hard link fails if the name is there, and shows the whole file
            os.makedirs(folder, exist_ok=True)
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with open(draft, "wb") as f:
                f.write(data)
            try:
                os.link(draft, f"{folder}/{name}")
            except FileExistsError as e:
                raise Taken(f"entry {number} of {self.folder}") from e
            finally:
                os.remove(draft)
            return number
        fs, path = self._fs(name)
        try:
            out = fs.createFile(path).recursive().overwrite(False).build()
        except Exception as e:  # the store says that the file is there
            if fs.exists(path):
                raise Taken(f"entry {number} of {self.folder}") from e
            raise
        out.write(bytearray(data))
        out.close()
        return number

    def change(self, make, attempts: int = 20) -> dict:
        """Appends make(last entry) behind the last entry; where another writer was first, `make` decides again on what that left."""
        for _ in range(attempts):
            number, entry = self.last()
            new = make(entry)
            try:
                self.append(number, new)
            except Taken:
                continue
            return new
        raise Taken(f"{attempts} others were first in {self.folder}")


@dataclass(frozen=True)
class KeyedTable:
    """The newest row of each key, kept current by small additions.

    Rows are dealt to `buckets` by a hash of the key. An addition writes a folder with the buckets that it touches; the log's entry lists the folders of each
    bucket in order. A bucket of more than `most` folders is merged into one, alone, so what a batch writes follows the batch.
    Of rows of one key that with the largest `at` counts, then the smallest `tie`, then that of the later addition.
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str
    at: str
    tie: str
    buckets: int = 64
    most: int = 8

    @property
    def log(self) -> Log:
        return Log(self.spark, f"{self.path}/_log")

    def _order(self):
        last = lambda c: F.col(c).desc_nulls_last()
        return [last(self.at), F.col(self.tie).asc_nulls_last(), last("_place")]

    def _newest(self, rows: DataFrame) -> DataFrame:
        return pick(rows, [self.key], *self._order())

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("_bucket")

    def _folders(self, entry: dict, only: list[int] | None = None) -> DataFrame:
        """Rows of the buckets' folders, with `_place`: how late a folder was added."""
        wanted = {b: f for b, f in entry["buckets"].items() if only is None or int(b) in only}
        out = None
        for folder in sorted({x for fs in wanted.values() for x in fs}, key=entry["folders"].index):
            parts = [f"{self.path}/{folder}/_bucket={b}" for b, fs in wanted.items() if folder in fs]
            rows = self.spark.read.schema(self.schema).parquet(*parts).withColumn("_place", F.lit(entry["folders"].index(folder)))
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else self.spark.createDataFrame([], self.schema).withColumn("_place", F.lit(0))

    def read(self) -> DataFrame:
        """The newest row of each key."""
        _, entry = self.log.last()
        return self._newest(self._folders(entry or {"buckets": {}, "folders": []})).drop("_place")

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A new folder with the rows by bucket; its name and its buckets."""
        name = f"data-{uuid.uuid4().hex}"
        rows.select(*self.schema.names, self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        return name, self._written(name)

    def _written(self, name: str) -> list[int]:
        fs, path = Log(self.spark, f"{self.path}/{name}")._fs()
        return sorted(int(s.getPath().getName()[len("_bucket=") :]) for s in fs.listStatus(path) if s.getPath().getName().startswith("_bucket="))

    def add(self, batch: DataFrame, mark: int | None = None) -> dict:
        """Adds rows; `mark` is a rising number of the batch, and a batch whose mark is there already changes nothing. Returns the entry."""
        _, entry = self.log.last()
        if mark is not None and entry and entry["mark"] is not None and mark <= entry["mark"]:
            return entry
        newest = self._newest(batch.select(*self.schema.names).withColumn("_place", F.lit(0))).drop("_place")
        name, touched = self._write(newest)

        def make(last: dict | None) -> dict:
            last = last or {"buckets": {}, "folders": [], "mark": None}
            if mark is not None and last["mark"] is not None and mark <= last["mark"]:
                return last
            buckets = {b: list(f) for b, f in last["buckets"].items()}
            for b in touched:
                buckets.setdefault(str(b), []).append(name)
            return {"buckets": buckets, "folders": [*last["folders"], name] if touched else last["folders"], "mark": last["mark"] if mark is None else mark}

        entry = self.log.change(make)
        full = [int(b) for b, f in entry["buckets"].items() if len(f) > self.most]
        return self.merge(entry, full) if full else entry

    def merge(self, entry: dict, which: list[int]) -> dict:
        """Puts one folder in the place of all those that some buckets have; additions made meanwhile stay behind it."""
        name, held = self._write(self._newest(self._folders(entry, which)))

        def make(last: dict) -> dict:
            buckets = {b: list(f) for b, f in last["buckets"].items()}
            for b in map(str, which):
                old = entry["buckets"][b]
                if buckets.get(b, [])[: len(old)] != old:  # merged by another writer
                    continue
                buckets[b] = ([name] if int(b) in held else []) + buckets[b][len(old) :]
            used = {x for f in buckets.values() for x in f}
            folders = [name] * (name in used) + [x for x in last["folders"] if x in used]
            return {"buckets": buckets, "folders": folders, "mark": last["mark"]}

        return self.log.change(make)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes folders that none of the last `keep` entries names; only while nothing is being added."""
        numbers = self.log.numbers()
        named = {x for n in numbers[-keep:] for f in (self.log.read(n) or {"buckets": {}})["buckets"].values() for x in f}
        fs, path = Log(self.spark, self.path)._fs()
        gone = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("data-") and s.getPath().getName() not in named]
        for p in gone:
            fs.delete(p, True)
        return [p.getName() for p in gone]
