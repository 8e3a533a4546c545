"""Variants, release tables, loads and publication over records made of the given tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import variants
from ..operators.relational import table_counts
from ..plans import payloads, release
from .base import query
from .extracted import EXTRACTED_SQL, NO_SHAPES, extracted, records, wires
from .scratch import scratch

_SHEET = "CASE WHEN k < 10 THEN '0' || k ELSE k::VARCHAR END"
_REFS = "(2 + (kind = 'mounting_hardware' OR k % 3 <> 0)::INT)"


def _configs(spark, d):
    return variants.configurations(records(spark, d), spark.createDataFrame([], NO_SHAPES))


@query(f"""
WITH {EXTRACTED_SQL}, ins AS (SELECT *, unnest(range(1, n_inserts + 1)) AS i FROM docs WHERE kind IN ('plug_receptacle', 'pcb_tail')),
v AS (SELECT *, unnest(range(1, 1 + CASE WHEN k BETWEEN 6 AND 9 THEN 1 ELSE greatest(1, n_finishes) END)) AS j FROM ins)
SELECT {_SHEET} AS slash_sheet, substr('ABCDEF', i::INT, 1) AS insert_code, CASE WHEN n_finishes > 0 AND k NOT BETWEEN 6 AND 9 THEN substr('ACK', j::INT, 1) END AS finish_code,
  'M83513/' || {_SHEET} || '-' || substr('ABCDEF', i::INT, 1) || CASE WHEN n_finishes > 0 AND k NOT BETWEEN 6 AND 9 THEN substr('ACK', j::INT, 1) ELSE '' END AS example_pin FROM v
UNION ALL SELECT {_SHEET}, NULL, NULL, NULL FROM docs WHERE kind IN ('base_spec', 'mounting_hardware')
""")
def j_variants(spark, d):
    """Every supplier's orderable variants with their part numbers, and one row for each general or hardware sheet."""
    return _configs(spark, d).select("slash_sheet", "insert_code", "finish_code", "example_pin")


@query(f"WITH {EXTRACTED_SQL} SELECT {_SHEET} AS slash_sheet, n_configs * wires AS wire_rows FROM docs JOIN ws USING (k)")
def j_variant_wires(spark, d):
    """Variants times the wires of their sheet."""
    return variants.wire_rows(_configs(spark, d), wires(spark, d)).groupBy("slash_sheet").agg(F.count("*").alias("wire_rows"))


def _release(spark, d, name, only=None):
    rows = records(spark, d) if only is None else records(spark, d).where(only)
    docs = release.documents(rows)
    configs = release.configurations(variants.configurations(rows, spark.createDataFrame([], NO_SHAPES)), docs, name)
    return {"documents": docs, "configurations": configs, "relationships": release.relationships(configs)}


@query(f"""
WITH {EXTRACTED_SQL} SELECT 'documents' AS table_name, count(*)::INT AS n_rows FROM docs
UNION ALL SELECT 'configurations', sum(n_configs)::INT FROM docs UNION ALL SELECT 'relationships', sum(n_configs * {_REFS})::INT FROM docs
""")
def k_release_tables(spark, d):
    """A release written table by table and read back."""
    root, parts = scratch(spark), _release(spark, d, "r1")
    release.write_release(parts, root, "r1", apply=True)
    return table_counts({n: spark.read.parquet(f"{root}/r1/{n}") for n in parts}).select("table_name", F.col("n_rows").cast("int").alias("n_rows"))


def _green(spark):
    return spark.createDataFrame([("all", "pass")], "name string, status string")


@query(f"WITH {EXTRACTED_SQL} SELECT '83513' AS spec_family, 'r2' AS release_id, sum(n_configs) FILTER (k % 2 = 0)::INT AS n_rows, sum(n_configs)::INT AS n_old_rows FROM docs")
def k_publish_pointer(spark, d):
    """The pointer moves from one release to the next: rows of the old one leave the serving view, and stay readable."""
    root = scratch(spark)
    both = _release(spark, d, "r1")["configurations"].unionByName(_release(spark, d, "r2", F.col("doc_key").cast("int") % 2 == 0)["configurations"])
    for n, r in enumerate(("r1", "r2")):
        pointer = release.publish(spark, root, "83513", r, "published", _green(spark), datetime(2024, 1, 1 + n), n)
    shown = release.current(both, pointer).agg(F.count("*").cast("int").alias("n_rows"))
    old = both.where("release_id = 'r1'").agg(F.count("*").cast("int").alias("n_old_rows"))
    return pointer.crossJoin(F.broadcast(shown)).crossJoin(F.broadcast(old))  # one row each


def _loads(spark, d, root):
    """Release r1 of all suppliers, then r2 of the even ones."""
    even = F.col("doc_key").cast("int") % 2 == 0
    for n, (name, only) in enumerate((("r1", None), ("r2", even)), 1):
        tables = payloads.release_payloads(spark, extracted(spark, d, only), name, "published", datetime(2024, 1, n))
        release.load_release(tables, root, n, payloads.orphan_gate, datetime(2024, 1, n), apply=True)
    return {name: release.loaded(spark, root, name) for name in release.LOAD_ORDER}


_VALUES = "(SELECT DISTINCT profile, context, thread, lo, hi FROM tq WHERE profile IS NOT NULL AND lo IS NOT NULL AND hi IS NOT NULL"
_MAPPED = "CASE WHEN k BETWEEN 1 AND 7 OR k = 9 THEN 'main' WHEN k BETWEEN 10 AND 33 THEN 'board' WHEN k = 8 THEN 'provisional' END"
_COUNTS = [
    ("publish.releases", "2"), ("ingest.documents", "(SELECT count(*) FROM docs)"),
    ("ingest.document_chunks", "(SELECT count(*) FROM documents WHERE doc_id % (SELECT max(k) FROM docs) + 1 IN (SELECT k FROM docs))"),
    ("extract.extraction_runs", "(SELECT count(*) + count(*) FILTER (k % 2 = 0) FROM docs)"), ("extract.extraction_outputs", "(SELECT count(*) + count(*) FILTER (k % 2 = 0) FROM docs)"),
    ("extract.extraction_evidence", "(SELECT count(*) + count(*) FILTER (k % 2 = 0) FROM tq)"),
    ("catalog.configurations", "(SELECT sum(n_configs) + sum(n_configs) FILTER (k % 2 = 0) FROM docs)"),
    ("catalog.wire_options", "(SELECT sum(n_configs * wires) + sum(n_configs * wires) FILTER (k % 2 = 0) FROM docs JOIN ws USING (k))"),
    ("catalog.hardware_options", "(SELECT 2 * coalesce(sum(n_configs) FILTER (k % 5 = 0), 0) + 2 * coalesce(sum(n_configs) FILTER (k % 10 = 0), 0) FROM docs)"),
    ("catalog.torque_profiles", "(SELECT count(DISTINCT profile) + count(DISTINCT CASE WHEN k % 2 = 0 THEN profile END) FROM tq)"),
    ("catalog.torque_profile_values", f"(SELECT count(*) FROM {_VALUES})) + (SELECT count(*) FROM {_VALUES} AND k % 2 = 0))"),
    ("catalog.document_profile_links", f"(SELECT count(*) FROM docs WHERE {_MAPPED} IN (SELECT profile FROM tq)) + (SELECT count(*) FROM docs WHERE k % 2 = 0 AND {_MAPPED} IN (SELECT profile FROM tq WHERE k % 2 = 0))"),
    ("catalog.mating_relationships", f"(SELECT sum(n_configs * {_REFS}) + sum(n_configs * {_REFS}) FILTER (k % 2 = 0) FROM docs)"),
    ("catalog.fact_evidence", "(SELECT count(*) + count(*) FILTER (k % 2 = 0) FROM tq)"), ("publish.active_releases", "1"),
]


@query(f"WITH {EXTRACTED_SQL} " + " UNION ALL ".join(f"SELECT {i} AS position, '{name}' AS table_name, ({sql})::BIGINT AS n_rows" for i, (name, sql) in enumerate(_COUNTS)))
def k_load_release(spark, d):
    """All fifteen tables built from records and loaded twice, with the gate that no row is an orphan; documents and chunks of both releases are the same rows."""
    have = _loads(spark, d, scratch(spark))
    rows = [df.agg(F.count("*").alias("n_rows")).select(F.lit(i).alias("position"), F.lit(name).alias("table_name"), "n_rows") for i, (name, df) in enumerate(have.items())]
    return reduce(DataFrame.unionByName, rows)


@query(f"WITH {EXTRACTED_SQL} SELECT {_SHEET} AS slash_sheet, n_configs::BIGINT AS n_configs, 1::BIGINT AS n_outputs, coalesce(n, 0) AS n_evidence FROM docs LEFT JOIN (SELECT k, count(*) AS n FROM tq GROUP BY k) USING (k)")
def k_lineage(spark, d):
    """For each sheet of a release its configurations, the outputs of extraction they came from, and the evidence that their run has."""
    tables = payloads.release_payloads(spark, extracted(spark, d), "r1")
    sheets = tables["ingest.documents"].select(F.col("id").alias("document_id"), "slash_sheet")
    found = payloads.lineage(tables).join(sheets, "document_id")
    return found.groupBy("slash_sheet").agg(F.count("*").alias("n_configs"), F.count_distinct("output_id").alias("n_outputs"), F.max("n_evidence").alias("n_evidence"))


@query(f"""
WITH {EXTRACTED_SQL}, gone AS (SELECT k FROM docs WHERE k % 7 = 0), c AS (
  SELECT 'ingest.document_chunks' AS table_name, count(*) AS n FROM gone WHERE k IN (SELECT doc_id % (SELECT max(k) FROM docs) + 1 FROM documents)
  UNION ALL SELECT 'extract.extraction_runs', count(*) FROM gone UNION ALL SELECT 'extract.extraction_outputs', count(*) FROM gone
  UNION ALL SELECT 'extract.extraction_evidence', count(*) FROM gone WHERE k IN (SELECT k FROM tq) UNION ALL SELECT 'catalog.configurations', count(*) FROM gone
  UNION ALL SELECT 'catalog.document_profile_links', count(*) FROM gone WHERE {_MAPPED} IN (SELECT profile FROM tq) UNION ALL SELECT 'catalog.fact_evidence', count(*) FROM gone WHERE k IN (SELECT k FROM tq))
SELECT table_name, 'document_id' AS column_name, n FROM c WHERE n > 0
""")
def k_orphans(spark, d):
    """Every seventh document taken out of a release: the documents that each table then misses."""
    tables = payloads.release_payloads(spark, extracted(spark, d), "r1")
    docs = tables["ingest.documents"]
    left = tables | {"ingest.documents": docs.where("cast(slash_sheet as int) % 7 != 0")}
    return payloads.orphans(left).groupBy("table_name", "column_name").agg(F.count("*").alias("n"))
