"""All fifteen tables of a release from extraction records, each row with the ids of what it came from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..operators import dims, torque, variants
from . import release

FAMILY = variants.FAMILY
PARSER, REGISTRY = "1", "1"
#: Facts of an extraction record besides what the row builders need; a record table may lack any of them.
RUN_FACTS = "checks string, flags array<string>, needs_fallback boolean, source_sha256 string, issues string"
TORQUE = "doc_key string, spec_sheet string, context string, applies_to string, thread string, scope string, min_in_lbf double, max_in_lbf double, source_page int, torque_text string, ordinal long"


@dataclass(frozen=True)
class Extracted:
    """What extraction gives: a record a document (`variants.RECORD` with any of RUN_FACTS), geometry rows, wires by sheet, torque rows, chunks by page, metadata."""

    records: DataFrame
    shapes: DataFrame
    wires: DataFrame
    torque_rows: DataFrame
    chunks: DataFrame
    metadata: DataFrame | None = None


def release_id(spark: SparkSession, name: str) -> str:
    return spark.range(1).select(v.stable_id("release", F.lit(FAMILY), F.lit(name)).alias("id")).first()["id"]


def _with_facts(records: DataFrame) -> DataFrame:
    """Records with all of RUN_FACTS, null where they lack one."""
    from pyspark.sql.types import StructType

    lacking = {f.name: F.lit(None).cast(f.dataType) for f in StructType.fromDDL(RUN_FACTS) if f.name not in records.columns}
    return records.withColumns(lacking) if lacking else records


def runs(records: DataFrame, docs: DataFrame, name: str, at: datetime | None) -> DataFrame:
    """One run a document: its id follows from the release's name, the document and the source's checksum."""
    r = _with_facts(records).withColumn("slash_sheet", release.t.sheet_key("doc_key")).join(docs.select("slash_sheet", "document_id"), "slash_sheet")
    ident = v.stable_id("extraction_run", F.lit(name), F.col("document_id"), F.coalesce("source_sha256", F.lit("")))
    summary = v.canonical_json(validation_checks=v.json_or("checks", "[]"), fallback_flags=v.array_or_empty("flags"))
    when = F.lit(at).cast("timestamp")
    return r.select(
        ident.alias("id"), "document_id", F.lit(PARSER).alias("parser_version"), F.lit(REGISTRY).alias("registry_version"), F.lit("release_build").alias("run_type"), F.lit("completed").alias("status"),
        "confidence_score", summary.alias("validation_summary"), when.alias("started_at"), when.alias("completed_at"), "doc_key",
    )


def outputs(records: DataFrame, of_run: DataFrame) -> DataFrame:
    """Each run's whole record as JSON, with the sizes of its lists."""
    lists = ("components", "insert_arrangements", "finishes", "mates_with", "hardware_options", "example_parts")
    r = _with_facts(records)
    presence = v.canonical_json(**{c: F.coalesce(F.array_size(c), F.lit(0)) for c in lists})
    whole = F.to_json(F.struct(*[F.col(c) for c in sorted(records.columns)]))
    own = r.select("doc_key", whole.alias("output_json"), v.json_or("issues", "[]").alias("issues_json"), presence.alias("field_presence"), F.coalesce("needs_fallback", F.lit(False)).alias("fallback_required"), F.col("source_sha256").alias("source_hash"))
    joined = of_run.select(F.col("id").alias("run_id"), "document_id", "doc_key").join(own, "doc_key").drop("doc_key")
    return joined.select(v.stable_id("extraction_output", F.col("run_id"), F.col("document_id")).alias("id"), *joined.columns)


def keyed_torque(rows: DataFrame) -> DataFrame:
    """Torque rows with a repeatable key; rows that say the same are one."""
    named = rows.withColumn("slash_sheet", release.t.sheet_key("doc_key")).withColumn("spec_family", F.lit(FAMILY))
    return variants.torque_key(named).dropDuplicates(["torque_key"])


def evidence(rows: DataFrame, of_run: DataFrame, confidences: DataFrame) -> DataFrame:
    """What each run says of a fact, and where."""
    r = rows.join(of_run.select(F.col("id").alias("run_id"), "document_id", "doc_key"), "doc_key").join(confidences, "doc_key")
    return r.select(
        v.stable_id("extraction_evidence", F.col("run_id"), F.col("torque_key")).alias("id"), "run_id", "document_id", F.lit("torque").alias("fact_type"), F.col("torque_key").alias("fact_key"),
        F.col("source_page").alias("page_number"), F.col("torque_text").alias("source_text"), F.col("spec_sheet").alias("source_ref"), F.col("confidence_score").alias("confidence"),
        v.canonical_json(context=F.col("context"), fastener_thread=F.col("thread"), arrangement_scope=F.col("scope")).alias("attributes"),
    )


def torque_catalog(spark: SparkSession, rows: DataFrame, docs: DataFrame, said: DataFrame, rid: str) -> dict[str, DataFrame]:
    """Profiles that some sheet's rows speak of, their values, the documents' links to them, and the rows as evidence of facts."""
    status = torque.classify(docs.select("slash_sheet", "spec_sheet"), rows.withColumn("extracted_at", F.lit(None).cast("string")), dims.profile_rules(spark))
    spoken = rows.select("spec_sheet").join(status.select("spec_sheet", "profile_code"), "spec_sheet").select("profile_code")
    known = spark.createDataFrame(dims.PROFILES, "profile_code string, profile_kind string, truth_level string, profile_status string, approval_status string, governing_sheet string")
    source = docs.select(F.col("slash_sheet").alias("governing_sheet"), F.col("document_id").alias("source_document_id"), F.col("spec_sheet").alias("source_spec_sheet"))
    profiles = known.join(spoken, "profile_code", "left_semi").join(source, "governing_sheet", "left")  # three rows
    profiles = profiles.select(v.stable_id("torque_profile", F.lit(rid), F.col("profile_code")).alias("id"), F.lit(rid).alias("release_id"), "*")
    facts = torque.profile_values(rows, status).join(profiles.select("profile_code", F.col("id").alias("profile_id")), "profile_code")
    facts = facts.join(said.select(F.col("fact_key").alias("torque_key"), F.col("id").alias("evidence_id")), "torque_key", "left")
    values = facts.select(
        v.stable_id("torque_profile_value", F.col("profile_id"), F.col("fact_key")).alias("id"), "profile_id", "evidence_id", "context", F.col("thread").alias("fastener_thread"),
        F.col("scope").alias("arrangement_scope"), F.col("min_in_lbf").alias("torque_min_in_lbf"), F.col("max_in_lbf").alias("torque_max_in_lbf"), F.col("fact_key").alias("normalized_fact_key"),
    )
    mapping = status.join(profiles.select("profile_code", F.col("id").alias("profile_id")), "profile_code").select("spec_sheet", "profile_id", "mapping_type")
    as_profiles = profiles.select(F.col("id").alias("profile_id"), F.col("profile_kind").alias("kind"), "profile_status", "truth_level", "approval_status", "source_spec_sheet")
    links = release.profile_links(status.select("spec_sheet", "torque_mode", "audit_status"), mapping, as_profiles, facts.select("profile_id"), rows.select("spec_sheet"), docs, rid)
    of_doc = rows.drop("spec_sheet").join(docs.select("slash_sheet", "document_id", "spec_sheet"), "slash_sheet").join(said.select(F.col("fact_key").alias("torque_key"), F.col("id").alias("evidence_id")), "torque_key", "left")
    fact_evidence = of_doc.select(
        v.stable_id("torque_fact_evidence", F.lit(rid), F.col("torque_key")).alias("id"), F.lit("document_torque_fact").alias("entity_type"), F.col("document_id").alias("entity_id"),
        F.col("context").alias("fact_name"), "document_id", "evidence_id", F.col("source_page").alias("page_number"), F.col("torque_text").alias("source_text"),
    )
    return {
        "catalog.torque_profiles": profiles.select("id", "release_id", "profile_code", "source_document_id", "profile_status", "profile_kind", "truth_level", "approval_status"),
        "catalog.torque_profile_values": values, "catalog.document_profile_links": links, "catalog.fact_evidence": fact_evidence,
    }


def release_payloads(spark: SparkSession, x: Extracted, name: str, status: str = "staged", at: datetime | None = None, created_from_run: str | None = None) -> dict[str, DataFrame]:
    """The tables of `release.LOAD_ORDER`. Ids follow from contents and the release's name, so a release that is built again has the same rows.

    Documents keep their id over releases; runs, outputs and what the catalog says are the release's own. A record whose sheet has no key is left out.
    """
    rid = release_id(spark, name)
    docs = release.documents(x.records.where(release.t.sheet_key("doc_key").isNotNull()), x.metadata)
    of_run = runs(x.records, docs, name, at)
    rows = keyed_torque(x.torque_rows)
    said = evidence(rows, of_run, x.records.select("doc_key", "confidence_score"))
    own = of_run.select("document_id", F.col("id").alias("run_id"))
    configs = release.configurations(variants.configurations(x.records, x.shapes), docs, rid).join(own, "document_id")
    wires = variants.wire_rows(configs.select("slash_sheet", "config_id"), x.wires)
    stamp = F.lit(at).cast("timestamp")
    table = {
        "publish.releases": spark.range(1).select(
            F.lit(rid).alias("id"), F.lit(FAMILY).alias("spec_family"), F.lit(name).alias("release_name"), F.lit(created_from_run).cast("string").alias("created_from_run_id"),
            F.lit(status).alias("status"), (stamp if status == "published" else F.lit(None).cast("timestamp")).alias("published_at"),
        ),
        release.POINTER: spark.range(1).select(F.lit(FAMILY).alias("spec_family"), F.lit(rid).alias("release_id")),
        "ingest.documents": docs.withColumnRenamed("document_id", "id"),
        "ingest.document_chunks": release.chunks(x.chunks, docs),
        "extract.extraction_runs": of_run.drop("doc_key"),
        "extract.extraction_outputs": outputs(x.records, of_run),
        "extract.extraction_evidence": said,
        "catalog.configurations": configs.withColumnRenamed("config_id", "id"),
        "catalog.wire_options": wires.select(v.stable_id("wire_option", F.lit(rid), F.col("config_id"), F.col("wire_code")).alias("id"), F.col("config_id").alias("configuration_id"), "wire_code", "wire_spec", "length_in", "notes", "space_approved"),
        "catalog.hardware_options": release.hardware_options(configs).withColumnRenamed("config_id", "configuration_id"),
        "catalog.mating_relationships": release.relationships(configs).withColumnRenamed("config_id", "configuration_id"),
    }
    return table | torque_catalog(spark, rows, docs, said, rid)


#: Each reference of a table to the id of another: (table, column, table). A null refers to nothing.
REFERENCES = (
    ("ingest.document_chunks", "document_id", "ingest.documents"),
    ("extract.extraction_runs", "document_id", "ingest.documents"),
    ("extract.extraction_outputs", "run_id", "extract.extraction_runs"),
    ("extract.extraction_outputs", "document_id", "ingest.documents"),
    ("extract.extraction_evidence", "run_id", "extract.extraction_runs"),
    ("extract.extraction_evidence", "document_id", "ingest.documents"),
    ("catalog.configurations", "release_id", "publish.releases"),
    ("catalog.configurations", "document_id", "ingest.documents"),
    ("catalog.configurations", "run_id", "extract.extraction_runs"),
    ("catalog.wire_options", "configuration_id", "catalog.configurations"),
    ("catalog.hardware_options", "configuration_id", "catalog.configurations"),
    ("catalog.torque_profiles", "release_id", "publish.releases"),
    ("catalog.torque_profiles", "source_document_id", "ingest.documents"),
    ("catalog.torque_profile_values", "profile_id", "catalog.torque_profiles"),
    ("catalog.torque_profile_values", "evidence_id", "extract.extraction_evidence"),
    ("catalog.document_profile_links", "release_id", "publish.releases"),
    ("catalog.document_profile_links", "document_id", "ingest.documents"),
    ("catalog.document_profile_links", "profile_id", "catalog.torque_profiles"),
    ("catalog.mating_relationships", "configuration_id", "catalog.configurations"),
    ("catalog.fact_evidence", "document_id", "ingest.documents"),
    ("catalog.fact_evidence", "evidence_id", "extract.extraction_evidence"),
    ("publish.active_releases", "release_id", "publish.releases"),
)


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, missing_id): references to rows that aren't there, one row for each missing id; one anti join for all tables."""
    told = [
        tables[child].where(F.col(column).isNotNull()).select(F.lit(parent).alias("parent"), F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("missing_id"))
        for child, column, parent in REFERENCES
    ]
    there = [tables[name].select(F.lit(name).alias("parent"), F.col("id").cast("string").alias("missing_id")) for name in dict.fromkeys(parent for _, _, parent in REFERENCES)]
    asked, have = reduce(DataFrame.unionByName, told).distinct(), reduce(DataFrame.unionByName, there)
    return asked.join(have, ["parent", "missing_id"], "left_anti").select("table_name", "column_name", "missing_id")


def lineage(tables: dict[str, DataFrame]) -> DataFrame:
    """(configuration_id, document_id, run_id, output_id, n_evidence): for each configuration the run and output it came from, and how many facts that run has evidence of."""
    said = tables["extract.extraction_evidence"].groupBy("run_id").agg(F.count("*").alias("n_evidence"))
    out = tables["extract.extraction_outputs"].select(F.col("id").alias("output_id"), "run_id")
    configs = tables["catalog.configurations"].select(F.col("id").alias("configuration_id"), "document_id", "run_id")
    return configs.join(out, "run_id", "left").join(said, "run_id", "left").withColumn("n_evidence", F.coalesce("n_evidence", F.lit(0)))


def orphan_gate(tables: dict[str, DataFrame]) -> DataFrame:
    """One gate: no reference without its row."""
    n: Column = F.count("*")
    return orphans(tables).agg(F.lit("no orphans").alias("name"), F.when(n == 0, "pass").otherwise("fail").alias("status"))
