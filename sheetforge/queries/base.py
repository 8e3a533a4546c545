"""Registration of queries, and the stand-in tables on which catalog operators run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def configurations(spark: SparkSession, d: str) -> DataFrame:
    """The table part in the shape of configurations."""
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    n = F.substr("p_brand", F.lit(7)).cast("int")
    sheet = F.lpad(F.substr("p_brand", F.lit(7)), 2, "0")
    pick = lambda s, m: F.substr(F.lit(s), (k % m).cast("int") + 1, F.lit(1))
    mate = lambda x: F.concat(F.lit("MIL-DTL-83513/"), (x % 25 + 1).cast("string"))
    return p.select(
        k.cast("string").alias("config_id"), sheet.alias("slash_sheet"), F.col("p_type").alias("connector_type"), F.col("p_size").alias("cavity_count"),
        F.when(k % 7 != 0, pick("ABC", 3)).alias("shell_letter"), pick("ACKNPT", 6).alias("finish_code"),
        F.when(k % 2 == 0, "Plug").otherwise("Receptacle").alias("gender"), F.when(k % 4 < 2, "Pin").otherwise("Socket").alias("contact_type"),
        F.col("p_name").alias("name"), F.upper(F.concat_ws(" ", "p_type", "p_name")).alias("description"),
        F.concat(F.lit("M83513/"), sheet, F.lit("-"), pick("ACKNPT", 6)).alias("example_pin"), F.col("p_brand").alias("spec_sheet"),
        F.when(k % 5 != 0, pick("ABCDEFGH", 8)).alias("revision"), (k % 9).cast("int").alias("source_page"),
        F.array(mate(n), mate(n + 4)).alias("mates_with"), F.when(k % 3 != 0, "MIL-DTL-83513/5").alias("hardware_ref"), F.col("p_retailprice").alias("price"),
    )


PARTS_SQL = """
parts AS (
  SELECT p_partkey::VARCHAR AS config_id, lpad(substr(p_brand, 7), 2, '0') AS slash_sheet, p_type AS connector_type, p_size AS cavity_count,
    CASE WHEN p_partkey % 7 <> 0 THEN substr('ABC', (p_partkey % 3)::INT + 1, 1) END AS shell_letter,
    substr('ACKNPT', (p_partkey % 6)::INT + 1, 1) AS finish_code,
    CASE WHEN p_partkey % 2 = 0 THEN 'Plug' ELSE 'Receptacle' END AS gender,
    CASE WHEN p_partkey % 4 < 2 THEN 'Pin' ELSE 'Socket' END AS contact_type,
    p_name AS name, upper(p_type || ' ' || p_name) AS description,
    'M83513/' || lpad(substr(p_brand, 7), 2, '0') || '-' || substr('ACKNPT', (p_partkey % 6)::INT + 1, 1) AS example_pin, p_brand AS spec_sheet,
    CASE WHEN p_partkey % 5 <> 0 THEN substr('ABCDEFGH', (p_partkey % 8)::INT + 1, 1) END AS revision, (p_partkey % 9)::INT AS source_page,
    [substr(p_brand, 7)::INT % 25 + 1, (substr(p_brand, 7)::INT + 4) % 25 + 1] AS mate_numbers,
    CASE WHEN p_partkey % 3 <> 0 THEN 'MIL-DTL-83513/5' END AS hardware_ref, p_retailprice AS price
  FROM part
)
"""
