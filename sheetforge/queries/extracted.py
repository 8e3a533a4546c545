"""Extraction results made of the given tables: a supplier stands for a document, its order lines for wires and torque rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import variants
from ..plans.payloads import TORQUE, Extracted
from ..sources.tables import table

_CAVITIES = [9, 15, 21, 25, 31, 37]
_LETTERS, _CODES = "ABCDEF", "ACK"
NO_SHAPES = "doc_key string, page_number int, cavity_count int, shell_letter string, dimensions map<string,double>, ordinal int"


def records(spark: SparkSession, d: str) -> DataFrame:
    """A record for every supplier: its kind, inserts and finishes follow from its numbers."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey").cast("int")
    key, one = k.cast("string"), lambda c: F.lit(c).cast("string")
    digits = F.lpad(key, F.greatest(F.lit(2), F.length(key)), "0")  # a plain lpad cuts numbers from 100 on
    kind = F.when(k % 10 == 0, "base_spec").when(k % 10 == 5, "mounting_hardware").when(k % 10 == 6, "pcb_tail").otherwise("plug_receptacle")
    cavities = F.array(*[F.lit(c) for c in _CAVITIES])
    inserts = F.transform(F.sequence(F.lit(1), k % 4 + 2), lambda i: F.struct(F.substr(F.lit(_LETTERS), i, F.lit(1)).alias("insert_arrangement"), F.element_at(cavities, i).alias("cavity_count")))
    finish = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(F.substr(F.lit(_CODES), i, F.lit(1)).alias("code"), F.concat(F.lit("finish "), i.cast("string")).alias("description")))
    listed = F.slice(finish, F.lit(1), F.col("s_nationkey").cast("int") % 3)
    mates = F.array(F.concat(F.lit("MIL-DTL-83513/"), (k % 9 + 1).cast("string")), F.concat(F.lit("MIL-DTL-83513/"), (k % 4 + 10).cast("string")))
    empty = lambda t: F.array().cast(t)
    columns = {
        "doc_key": key, "document_type": kind, "spec_sheet": F.concat(F.lit("MIL-DTL-83513/"), key, F.lit("H")), "title": F.col("s_name"), "revision": F.lit("H"), "source_url": one(None),
        "confidence_score": F.lit(1.0), "prefix": F.concat(F.lit("M83513/"), digits), "components": F.array(F.lit("insert_arrangement"), F.lit("shell_finish_code")),
        "insert_arrangements": inserts, "finishes": listed, "gender": F.when(k % 2 == 0, "Plug").otherwise("Receptacle"), "contact_type": F.lit("Pin"), "termination_style": F.lit("Solder"),
        "class": F.lit("M"), "shell_material": F.lit("Metal"), "polarization": one(None), "current_rating": F.lit(3.0), "mates_with": mates,
        "hardware_ref": F.when(k % 3 != 0, "MIL-DTL-83513/5"), "termination_options": empty("array<struct<code:string,length_inches:double>>"),
        "hardware_options": empty("array<struct<code:string,description:string>>"), "example_parts": empty("array<string>"),
        "attributes": F.when(k % 5 == 0, '{"hardware_options":[{"code":"02","description":"screw"},{"code":"03","description":"nut"}]}').otherwise("{}"),
    }
    return s.select(*[c.alias(n) for n, c in columns.items()], F.sha2("s_name", 256).alias("source_sha256"), (k % 7 == 0).alias("needs_fallback"))


def wires(spark: SparkSession, d: str) -> DataFrame:
    """A wire of a sheet for each line number that its supplier has."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_linenumber").distinct()
    sheet, n = F.lpad(F.col("l_suppkey").cast("string"), F.greatest(F.lit(2), F.length(F.col("l_suppkey").cast("string"))), "0"), F.col("l_linenumber")
    return li.select(sheet.alias("slash_sheet"), F.lpad(n.cast("string"), 2, "0").alias("wire_code"), F.lit("spec").alias("wire_spec"), (n * 6.0).alias("length_in"), F.array(F.lit("note")).alias("note_texts"), (n % 2 == 0).alias("space_approved"))


def torque_rows(spark: SparkSession, d: str) -> DataFrame:
    """A torque row for each supplier, return flag and line status: the quantities' bounds."""
    g = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.count("*").alias("n"))
    key = F.col("l_suppkey").cast("string")
    return g.select(
        key.alias("doc_key"), F.concat(F.lit("MIL-DTL-83513/"), key, F.lit("H")).alias("spec_sheet"), F.when(F.col("l_returnflag") == "A", "mating_torque").otherwise("mounting_torque").alias("context"),
        F.col("l_returnflag").alias("applies_to"), F.when(F.col("l_linestatus") == "F", "#2-56").otherwise("#4-40").alias("thread"), F.lit("Metal shell").alias("scope"),
        F.when(F.col("n") % 5 != 0, F.col("lo")).alias("min_in_lbf"), F.col("hi").alias("max_in_lbf"), (F.col("n") % 9).cast("int").alias("source_page"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("n").cast("string")).alias("torque_text"), F.xxhash64("l_suppkey", "l_returnflag", "l_linestatus").alias("ordinal"),
    ).to(_schema(TORQUE))


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every document is a page of a supplier's sheet."""
    n = table(spark, d, "supplier").agg(F.max("s_suppkey").alias("n"))
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("chunk_text")).crossJoin(F.broadcast(n))  # one row
    return docs.select((F.col("doc_id") % F.col("n") + 1).cast("string").alias("doc_key"), F.col("doc_id").cast("int").alias("page_number"), F.concat_ws("-", F.lit("c"), F.col("doc_id").cast("string"), F.lit("1")).alias("chunk_id"), "chunk_text")


def extracted(spark: SparkSession, d: str, only=None) -> Extracted:
    """Everything of all suppliers, or of those that `only` (a condition on doc_key) holds for."""
    x = Extracted(records(spark, d), spark.createDataFrame([], NO_SHAPES), wires(spark, d), torque_rows(spark, d), chunks(spark, d))
    if only is None:
        return x
    return Extracted(x.records.where(only), x.shapes, x.wires, x.torque_rows.where(only), x.chunks.where(only))


#: The same in SQL: docs (k, kind, n_inserts, n_finishes, n_configs), ws (k, wires), tq (a row a torque row).
EXTRACTED_SQL = """
docs AS (
  SELECT s_suppkey::INT AS k, s_name, CASE s_suppkey % 10 WHEN 0 THEN 'base_spec' WHEN 5 THEN 'mounting_hardware' WHEN 6 THEN 'pcb_tail' ELSE 'plug_receptacle' END AS kind,
    s_suppkey % 4 + 2 AS n_inserts, s_nationkey % 3 AS n_finishes,
    CASE WHEN s_suppkey % 10 IN (0, 5) THEN 1 ELSE (s_suppkey % 4 + 2) * CASE WHEN s_suppkey BETWEEN 6 AND 9 THEN 1 ELSE greatest(1, s_nationkey % 3) END END AS n_configs
  FROM supplier
), ws AS (SELECT l_suppkey AS k, count(DISTINCT l_linenumber) AS wires FROM lineitem GROUP BY 1
), tq AS (
  SELECT l_suppkey AS k, l_returnflag AS flag, l_linestatus AS status, CASE WHEN count(*) % 5 <> 0 THEN min(l_quantity) END AS lo, max(l_quantity) AS hi, count(*) AS n,
    CASE WHEN l_returnflag = 'A' THEN 'mating' ELSE 'mounting' END AS context, CASE WHEN l_linestatus = 'F' THEN '#2-56' ELSE '#4-40' END AS thread,
    CASE WHEN l_suppkey BETWEEN 1 AND 7 OR l_suppkey = 9 THEN 'main' WHEN l_suppkey BETWEEN 10 AND 33 THEN 'board' WHEN l_suppkey = 8 THEN 'provisional' END AS profile
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3
)
"""
RECORD = variants.RECORD
