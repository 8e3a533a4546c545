"""Scans of tables, JSON records and files."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.relational import first_wins, last_wins


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; filters and columns reach its scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class TableQuery:
    """A chain over a table: equalities, then what is done with the rows that meet them all.

    Every end of a chain is a lazy DataFrame: the rows asked for, or the table as it is afterwards, which a writer stores. Null equals nothing.
    """

    rows: DataFrame
    met: tuple[Column, ...] = ()

    def eq(self, column: str, value) -> TableQuery:
        return replace(self, met=(*self.met, F.coalesce(F.col(column) == F.lit(value), F.lit(False))))

    def _where(self) -> Column:
        return reduce(lambda a, b: a & b, self.met, F.lit(True))

    def select(self, *columns: Column | str) -> DataFrame:
        return self.rows.where(self._where()).select(*(columns or ("*",)))

    def _whole(self, what: str) -> None:
        if self.met:
            raise ValueError(f"{what} takes no equalities")

    def insert(self, more: DataFrame) -> DataFrame:
        self._whole("an insert")
        return self.rows.unionByName(more)

    def upsert(self, arriving: DataFrame, *keys: str) -> DataFrame:
        """Arriving rows, one a key, take the place of those with their key."""
        self._whole("an upsert")
        return self.rows.join(arriving.select(*keys), list(keys), "left_anti").unionByName(arriving)

    def delete(self) -> DataFrame:
        """What stays; a chain without an equality is refused."""
        if not self.met:
            raise ValueError("a removal needs an equality")
        return self.rows.where(~self._where())


def extractions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Extraction records, one JSON object a file, with their numeric sheet key as `sheet_order`."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.withColumn("sheet_order", sheet_order("doc_key"))


def sheet_order(key: str) -> Column:
    """Base first, then by number."""
    return F.coalesce(F.expr(f"try_cast({key} as int)"), F.lit(-1))


def document_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata from files that are a list or an object with `documents`; the key is slash_sheet, else document_key; the last row wins."""
    text = spark.read.text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("file"))
    one = "struct<slash_sheet:string,document_key:string,spec_sheet:string,revision:string,title:string,source_url:string,storage_path:string,checksum:string,doc_date:string>"
    listed = F.coalesce(F.from_json("value", f"array<{one}>", {"mode": "PERMISSIVE"}), F.array().cast(f"array<{one}>"))
    wrapped = F.coalesce(F.from_json("value", f"struct<documents:array<{one}>>")["documents"], F.array().cast(f"array<{one}>"))
    is_list = F.trim("value").startswith("[")
    rows = text.select("file", F.posexplode(F.when(is_list, listed).otherwise(wrapped)).alias("i", "d")).select("file", "i", "d.*")
    rows = rows.withColumn("key", F.coalesce(t.sheet_key("slash_sheet"), t.sheet_key("document_key"))).where("key is not null")
    return last_wins(rows, ["key"], "file", "i").drop("file", "i")


def documents_of(rows: DataFrame) -> DataFrame:
    """One document row a sheet: the first by `ordinal`, with its order."""
    return first_wins(rows, ["slash_sheet"], "ordinal").withColumn("sheet_order", sheet_order("slash_sheet"))


def active_documents(documents: DataFrame, family: str, status: str = "active") -> DataFrame:
    return documents.where((F.col("spec_family") == family) & (F.col("status") == status) & F.col("is_latest"))


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, n_bytes, checksum, is_pdf) of files; the bytes stay on the executors."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return df.select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("checksum"), F.col("content").startswith(F.unhex(F.lit("25504446"))).alias("is_pdf"))


def source_manifest(discovered: DataFrame, stored: DataFrame, key: str = "file_name") -> DataFrame:
    """Every discovered document with the checksum and size of its stored file; null where there is none."""
    names = stored.withColumn(key, F.substring_index("path", "/", -1)).drop("path")
    return discovered.join(names, key, "left")
