"""Orderable variants: inserts by finishes, with geometry, names and wires."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from .relational import last_wins

#: One row a document: what the row builders need of an extraction record.
RECORD = (
    "doc_key string, document_type string, spec_sheet string, title string, revision string, source_url string, confidence_score double, "
    "prefix string, components array<string>, insert_arrangements array<struct<insert_arrangement:string,cavity_count:int>>, "
    "finishes array<struct<code:string,description:string>>, gender string, contact_type string, termination_style string, class string, "
    "shell_material string, polarization string, current_rating double, mates_with array<string>, hardware_ref string, "
    "termination_options array<struct<code:string,length_inches:double>>, hardware_options array<struct<code:string,description:string>>, "
    "example_parts array<string>, attributes string"
)
#: Documents of class P have no finish.
CLASS_P = ("06", "07", "08", "09")
FAMILY = "83513"


def orderable(records: DataFrame) -> DataFrame:
    """A row for each insert and finish of a document; documents of class P, or without finishes, get one null finish.

    Both lists belong to their document, so two explodes do it; no join.
    """
    sheet = text.sheet_key("doc_key")
    none = F.array(F.struct(F.lit(None).cast("string").alias("code"), F.lit("").alias("description")))
    bare = sheet.isin(*CLASS_P) | (F.size(values.array_or_empty("finishes", "struct<code:string,description:string>")) == 0)
    return (
        records.withColumn("slash_sheet", sheet)
        .withColumn("insert", F.explode("insert_arrangements"))
        .withColumn("finish", F.explode(F.when(bare, none).otherwise(F.col("finishes"))))
    )


def geometry(rows: DataFrame) -> DataFrame:
    """One geometry row a document and cavity count: the last (doc_key, cavity_count, shell_letter, page_number, dimensions, ordinal)."""
    return last_wins(rows, ["doc_key", "cavity_count"], "ordinal").drop("ordinal")


def variant_rows(records: DataFrame, shapes: DataFrame) -> DataFrame:
    """Configurations of plug, receptacle and PCB documents."""
    pcb = F.col("document_type") == "pcb_tail"
    v = orderable(records.where(F.col("document_type").isin("plug_receptacle", "pcb_tail")))
    v = v.withColumn("cavity_count", F.col("insert.cavity_count"))
    v = v.join(geometry(shapes), ["doc_key", "cavity_count"], "left")
    first = lambda c: F.get(F.col(c), F.lit(0))["code"]
    pin = text.part_number("prefix", F.col("insert.insert_arrangement"), "components", F.col("finish.code"), "01", F.when(pcb, first("termination_options")), F.when(pcb, first("hardware_options")))
    return v.select(
        F.lit(FAMILY).alias("spec_family"), "spec_sheet", "slash_sheet", "revision", "source_url", "confidence_score",
        text.connector_code("gender", "contact_type", "termination_style").alias("connector_type"),
        text.connector_name("gender", "contact_type", "termination_style", "class", "cavity_count").alias("name"),
        text.connector_description("gender", "contact_type", "termination_style", "class", "shell_material", "cavity_count", F.col("finish.description")).alias("description"),
        "cavity_count", F.when(~pcb, F.col("shell_letter")).alias("shell_letter"),
        F.concat("cavity_count", F.lit(" position")).alias("shell_size_description"),
        "dimensions", "shell_material", F.col("finish.code").alias("finish_code"), F.col("finish.description").alias("finish_description"),
        F.when(F.col("finish.code").isNotNull(), "Interface critical shell finish from the part number.").alias("finish_notes"),
        "current_rating", "contact_type", "gender", F.col("class").alias("class_code"), "termination_style", "polarization", "mates_with", "hardware_ref",
        F.col("insert.insert_arrangement").alias("insert_code"), F.coalesce("page_number", F.lit(1)).alias("source_page"), pin.alias("example_pin"), "attributes",
    )


def single_rows(records: DataFrame) -> DataFrame:
    """One row for a general specification or a hardware sheet; all variant columns are null."""
    hardware = F.col("document_type") == "mounting_hardware"
    none = lambda kind: F.lit(None).cast(kind)
    return records.where(F.col("document_type").isin("base_spec", "mounting_hardware")).select(
        F.lit(FAMILY).alias("spec_family"), "spec_sheet", text.sheet_key("doc_key").alias("slash_sheet"), "revision", "source_url", "confidence_score",
        F.when(hardware, "MOUNTING_HARDWARE").otherwise("GENERAL_SPECIFICATION").alias("connector_type"),
        F.when(hardware, "Micro-D Mounting Hardware").otherwise("Micro-D General Specification").alias("name"),
        F.upper("title").alias("description"), none("int").alias("cavity_count"), none("string").alias("shell_letter"), none("string").alias("shell_size_description"),
        none("map<string,double>").alias("dimensions"), none("string").alias("shell_material"), none("string").alias("finish_code"), none("string").alias("finish_description"),
        none("string").alias("finish_notes"), "current_rating", none("string").alias("contact_type"), none("string").alias("gender"), none("string").alias("class_code"),
        none("string").alias("termination_style"), "polarization", "mates_with", F.when(hardware, F.col("spec_sheet")).otherwise(F.col("hardware_ref")).alias("hardware_ref"),
        none("string").alias("insert_code"), F.lit(1).alias("source_page"), F.when(hardware, F.get("example_parts", F.lit(0))).alias("example_pin"), "attributes",
    )


def configurations(records: DataFrame, shapes: DataFrame) -> DataFrame:
    return variant_rows(records, shapes).unionByName(single_rows(records))


def wire_rows(configs: DataFrame, wires: DataFrame) -> DataFrame:
    """Every wire option of a configuration's sheet: (slash_sheet, wire_code, wire_spec, length_in, note_texts, space_approved)."""
    out = configs.join(wires, "slash_sheet").withColumn("notes", F.nullif(F.array_join("note_texts", " | "), F.lit("")))
    return out.withColumn("length_in", F.col("length_in").cast("decimal(6,2)"))


def staged_id(df: DataFrame) -> DataFrame:
    """A repeatable id of a configuration from its seven key parts."""
    parts = ["spec_sheet", "slash_sheet", "connector_type", "cavity_count", "shell_letter", "finish_code", "insert_code"]
    return df.withColumn("config_id", values.sha1_key("staged-base-", 24, *[F.col(c) for c in parts]))


def torque_key(df: DataFrame) -> DataFrame:
    """A repeatable id of a torque row from its eleven key parts; numbers that are null or 0 count as empty."""
    before = ["spec_family", "spec_sheet", "slash_sheet", "context", "applies_to", "thread", "scope"]
    numbers = [values.falsy_to_blank(F.col(c)) for c in ("min_in_lbf", "max_in_lbf")]
    return df.withColumn("torque_key", values.sha1_key("83513-torque-", 20, *[F.col(c) for c in before], *numbers, F.col("source_page"), F.col("torque_text")))
