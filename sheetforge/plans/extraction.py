"""Page text to one record a document: lists, components, tables, wires, torque, checks and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v
from ..operators import dims, extract, quality
from ..operators.relational import last_wins, tasks_for

#: Pages, or documents, of a task; a document's parts meet in one task, each of them sorted in memory.
PAGES = 40_000


def geometry(pages: DataFrame, components: DataFrame) -> DataFrame:
    """Geometry rows by document class: plug tables, and board-mount tables with made-up rows where none was read."""
    inserts = components.select("doc_key", "class", F.explode("insert_arrangements").alias("i")).select("doc_key", "class", "i.cavity_count")
    pcb = F.col("class") == "pcb"
    own = lambda which: pages.join(components.where(which).select("doc_key"), "doc_key", "left_semi")
    plug = extract.geometry_rows(own(F.col("class").isin("solder", "solder_p", "crimp", "crimp_p"))).drop("ordinal")
    return plug.unionByName(extract.with_synthesized(extract.pcb_rows(own(pcb)), inserts.where(pcb)))


def records(spark: SparkSession, pages: DataFrame, sources: DataFrame) -> DataFrame:
    """One row for each of `sources` (doc_key, title, spec_sheet, revision), with `checks`, `flags`, `confidence` and `needs_fallback`.

    The document's own header wins over the given spec sheet. Documents without pages have confidence 0. Pages are counted, and moved once
    to the tasks of their documents, where all that is read from them is put together: tasks grow in number with the pages, not in size.
    """
    tasks = tasks_for(spark, max(pages.count(), sources.count()), PAGES)
    pages, sources = pages.repartition(tasks, "doc_key"), sources.repartition(tasks, "doc_key")
    summary = extract.page_summary(pages)
    lists = extract.document_lists(summary)
    parts = extract.pin_components(pages)
    shape = geometry(pages, parts).groupBy("doc_key").agg(
        F.count("*").alias("n_configs"), F.array_sort(F.collect_set(F.when(F.size(F.map_keys("dimensions")) == 0, F.col("cavity_count")))).alias("empty_cavities")
    )
    bleed = F.exists("note_texts", lambda x: t.has_bleed(x))
    wires = extract.wire_options(pages).groupBy("doc_key").agg(F.array_sort(F.collect_list("wire_code")).alias("wire_codes"), F.array_sort(F.collect_set(F.when(bleed, F.col("wire_code")))).alias("bleed_codes"))
    figures = extract.document_figures(summary).groupBy("doc_key").agg(F.count("*").alias("n_figures"))
    torque = extract.torque_facts(pages).groupBy("doc_key").agg(F.count("*").alias("n_torque"))
    first = last_wins(pages.withColumn("o", -F.col("page_number")), ["doc_key"], "o").select("doc_key", F.col("text").alias("first_page"))
    whole = pages.groupBy("doc_key").agg(F.count("*").alias("n_pages"))
    body = extract.joined(pages).withColumnRenamed("text", "body")
    d = sources
    for part in (first, whole, body, lists, parts, shape, wires, figures, torque):
        d = d.join(part, "doc_key", "left")
    d = quality.identity(d)
    d = d.withColumn("class", extract.document_class("doc_key")).join(F.broadcast(dims.document_classes(spark)), "class")
    expected = dims.expected_codes(spark).withColumnRenamed("key", "_key")
    d = d.join(F.broadcast(expected), t.document_filter("doc_key") == F.col("_key"), "left").drop("_key")
    for name, column in extract.attributes("title", "body").items():
        d = d.withColumn(name if name != "class" else "class_code", column)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_pages", "n_configs", "n_figures", "n_torque")}
    empty = {c: v.array_or_empty(c) for c in ("mates_with", "example_parts", "wire_specs", "headers", "wire_codes", "bleed_codes")}
    empty |= {c: v.array_or_empty(c, "int") for c in ("cavity_counts", "empty_cavities")}
    d = d.withColumns(zero | empty).withColumn("inserts", F.coalesce(F.transform("insert_arrangements", lambda x: x["insert_arrangement"]), F.array().cast("array<string>")))
    d = d.withColumn("finishes", F.coalesce(F.transform("finishes", lambda x: x["code"]), F.array().cast("array<string>")))
    there = {
        "spec_sheet": F.col("spec_sheet").isNotNull(), "revision": F.col("revision").isNotNull(), "title": F.col("title").isNotNull(), "connector_type": F.lit(True), "cavity_counts": F.size("cavity_counts") > 0,
        "dimensions": F.col("n_configs") > F.size("empty_cavities"), "mates_with": F.size("mates_with") > 0, "example_parts": F.size("example_parts") > 0, "configuration_rows": F.col("n_configs") > 0,
        "pin_components": F.size("inserts") > 0, "wire_options": F.size("wire_codes") > 0, "figure_references": F.col("n_figures") > 0,
    }
    d = d.withColumn("present", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in there.items()])))
    return quality.confidence(quality.validation_checks(d)).drop("body", "first_page")


def as_json(rows: DataFrame) -> DataFrame:
    """(doc_key, record): each record as JSON with its keys in order, null fields left out."""
    return rows.select("doc_key", F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)])).alias("record"))


def replace_field(rows: DataFrame, name: str, value) -> DataFrame:
    """A record table with one field replaced in its place."""
    return rows.select(*[value.alias(c) if c == name else F.col(c) for c in rows.columns])
