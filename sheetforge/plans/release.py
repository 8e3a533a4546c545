"""A release: its tables from extraction records, its publication by a pointer, and its serving views."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as t
from ..functions import values as v
from ..operators.relational import last_wins, table_counts
from ..operators.torque import resolve
from ..sources.log import Log

#: The one pointer table: a row a family, kept as a log of small entries.
POINTER = "publish.active_releases"
POINTER_ROW = "spec_family string, release_id string, published_at timestamp, sequence long"


def documents(records: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Documents with stable ids; metadata fills what a record lacks."""
    d = records.withColumn("slash_sheet", t.sheet_key("doc_key"))
    if metadata is not None:
        m = metadata.select(F.col("key").alias("slash_sheet"), *[F.col(c).alias(f"m_{c}") for c in ("spec_sheet", "revision", "title", "source_url")])
        d = d.join(m, "slash_sheet", "left")
        d = d.withColumns({c: F.coalesce(c, f"m_{c}") for c in ("spec_sheet", "revision", "title", "source_url")})
    ident = v.stable_id("document", F.lit("83513"), F.col("slash_sheet"), F.col("revision"))
    return d.select(ident.alias("document_id"), F.lit("83513").alias("spec_family"), "slash_sheet", "spec_sheet", "revision", "title", "source_url", "document_type", F.lit("active").alias("status"))


def chunks(page_chunks: DataFrame, docs: DataFrame) -> DataFrame:
    """Chunks with ids; their index is the number at the end of the chunk id."""
    keyed = page_chunks.withColumn("slash_sheet", t.sheet_key("doc_key")).join(docs.select("slash_sheet", "document_id"), "slash_sheet")
    index = t.trailing_index("chunk_id")
    return keyed.select(v.stable_id("document_chunk", F.col("document_id"), F.col("page_number"), index).alias("id"), "document_id", "page_number", index.alias("chunk_index"), F.col("chunk_text").alias("text_content"))


def configurations(configs: DataFrame, docs: DataFrame, release_id: str) -> DataFrame:
    keyed = configs.join(docs.select("slash_sheet", "document_id"), "slash_sheet")
    parts = ["spec_sheet", "slash_sheet", "connector_type", "cavity_count", "shell_letter", "finish_code", "insert_code"]
    return keyed.withColumn("config_id", v.stable_id("configuration", F.lit(release_id), *[F.col(c) for c in parts])).withColumn("release_id", F.lit(release_id))


def relationships(configs: DataFrame) -> DataFrame:
    """One edge for each mate, and one for the hardware sheet where there is one."""
    edge = lambda kind, ref: F.struct(F.lit(kind).alias("relationship"), ref.alias("ref"))
    mates = F.transform(v.array_or_empty("mates_with"), lambda x: edge("mates_with", x))
    hardware = F.when(F.col("hardware_ref").isNotNull(), F.array(edge("mounting_hardware_ref", F.col("hardware_ref"))))
    every = F.concat(mates, F.coalesce(hardware, F.array().cast("array<struct<relationship:string,ref:string>>")))
    e = configs.select("release_id", "config_id", F.explode(every).alias("e"))
    return e.select(v.stable_id("relationship", F.col("config_id"), F.col("e.relationship"), F.col("e.ref")).alias("id"), "release_id", "config_id", "e.relationship", t.related_family("e.ref").alias("related_family"), t.related_sheet("e.ref").alias("related_sheet"), "e.ref")


def hardware_options(configs: DataFrame) -> DataFrame:
    e = configs.select("release_id", "config_id", F.explode(v.json_options("attributes")).alias("o"))
    return e.select(v.stable_id("hardware_option", F.col("config_id"), F.col("o.code")).alias("id"), "release_id", "config_id", "o.code", "o.description")


def profile_links(status: DataFrame, mapping: DataFrame, profiles: DataFrame, facts: DataFrame, evidence: DataFrame, docs: DataFrame, release_id: str) -> DataFrame:
    r = resolve(status, mapping, profiles, facts, evidence, "release").where("profile_id is not null").join(docs.select("spec_sheet", "document_id"), "spec_sheet")
    return r.select(v.stable_id("document_profile_link", F.lit(release_id), F.col("document_id"), F.col("profile_id")).alias("id"), F.lit(release_id).alias("release_id"), "document_id", "profile_id", "mapping_type", "values_inherited", "values_verified")


def field_presence(records: DataFrame, arrays: tuple[str, ...]) -> DataFrame:
    """Lengths of each record's nested arrays; null counts as 0."""
    return records.select("doc_key", *[F.coalesce(F.array_size(c), F.lit(0)).alias(c) for c in arrays])


# --- publication


def merge(stored: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: arriving rows replace stored ones of their key; of arriving rows of one key the last by `ordinal` counts."""
    new = last_wins(arriving, keys, "ordinal").drop("ordinal")
    return stored.join(new.select(*keys), keys, "left_anti").unionByName(new)


def not_older(stored: DataFrame, candidate: DataFrame, key: str, at: str) -> DataFrame:
    """Candidates that aren't older than what is stored; equal dates pass."""
    old = stored.select(key, F.col(at).alias("_stored"))
    return candidate.join(old, key, "left").where(F.col("_stored").isNull() | (F.col(at) >= F.col("_stored"))).drop("_stored")


def write_release(tables: dict[str, DataFrame], root: str, release_id: str, apply: bool = False) -> DataFrame:
    """Row counts of a release's tables; with `apply` they are written, each in a folder of its own, never over another release's."""
    counts = table_counts(tables)
    if apply:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{root}/{release_id}/{name}")
    return counts


#: A release's tables, parents before children and the pointer last.
LOAD_ORDER = (
    "publish.releases", "ingest.documents", "ingest.document_chunks", "extract.extraction_runs", "extract.extraction_outputs", "extract.extraction_evidence",
    "catalog.configurations", "catalog.wire_options", "catalog.hardware_options", "catalog.torque_profiles", "catalog.torque_profile_values",
    "catalog.document_profile_links", "catalog.mating_relationships", "catalog.fact_evidence", "publish.active_releases",
)


#: After so many loads each table's folders are merged into one.
MOST_LOADS = 8
#: Tables of a load that are written at a time.
WRITERS = 4


def load_key(name: str) -> str:
    """The column by which a table is upserted."""
    return "spec_family" if name == POINTER else "id"


def require_gates(gates: DataFrame | None) -> None:
    """An error unless there are gates and all pass; a gate without status doesn't."""
    if gates is None:
        raise ValueError("not every gate passes: there are none")
    passed = F.col("status").eqNullSafe(F.lit("pass"))
    n = gates.agg(F.count("*").alias("gates"), F.count_if(passed).alias("passed")).first()
    if not n["gates"] or n["passed"] != n["gates"]:
        raise ValueError("not every gate passes")


def _loads(spark: SparkSession, root: str) -> Log:
    return Log(spark, f"{root}/_loads")


def _below(entry: dict | None, sequence: int) -> list[dict]:
    """The loads that a new one comes behind; an equal number is the same load done again."""
    loads = entry["loads"] if entry else []
    if loads and loads[-1]["sequence"] > sequence:
        raise ValueError(f"load {sequence} is below {loads[-1]['sequence']}")
    return [x for x in loads if x["sequence"] < sequence]


def _checked(tables: dict[str, DataFrame]) -> DataFrame:
    """(position, table_name, n_rows) of all tables; keys that are null or occur twice are an error."""
    keys = [tables[name].select(F.lit(n).alias("position"), F.col(load_key(name)).cast("string").alias("key")) for n, name in enumerate(LOAD_ORDER)]
    by_key = reduce(DataFrame.unionByName, keys).groupBy("position", "key").agg(F.count("*").alias("n"))
    counted = by_key.groupBy("position").agg(F.sum("n").alias("n_rows"), F.count_if((F.col("n") > 1) | F.col("key").isNull()).alias("wrong"))
    spark = tables[LOAD_ORDER[0]].sparkSession
    found = {x["position"]: x for x in counted.collect()}  # a row a table
    if bad := [LOAD_ORDER[n] for n in sorted(found) if found[n]["wrong"]]:
        raise ValueError(f"keys are null or occur twice in {bad}")
    return spark.createDataFrame([(n, name, found[n]["n_rows"] if n in found else 0) for n, name in enumerate(LOAD_ORDER)], "position int, table_name string, n_rows long")


def load_release(
    payloads: dict[str, DataFrame], root: str, sequence: int, gates: DataFrame | Callable[[dict[str, DataFrame]], DataFrame] | None = None, published_at: datetime | None = None, apply: bool = False
) -> DataFrame:
    """(position, table_name, n_rows) of a whole load; with `apply` every table is upserted, in LOAD_ORDER, and the pointer moves last.

    Each table is written once to a folder of its own, which nobody reads, and checked there; then one entry of the log of loads shows them all at
    once. So a reader sees whole loads only, and what a task or a load that was cut off or refused has left is never read. The pointer is moved by `publish`, for
    releases whose row in publish.releases has the status published; the others are loaded and stay staged. Gates are needed, a table or a function of the
    written tables, and all must pass. A missing or unknown table, a key that is null or occurs twice, a pointer to a release that isn't in
    the load, and a load below one that is stored are errors, before anything can be read. A load that is done again under its number takes the place
    of what it left. Of several writers of one number the last entry counts; of several numbers the largest.
    """
    if set(payloads) != set(LOAD_ORDER):
        raise ValueError(f"missing or unknown tables: {sorted(set(payloads) ^ set(LOAD_ORDER))}")
    if not apply:
        return _checked(payloads)
    if not callable(gates):
        require_gates(gates)
    spark = payloads[POINTER].sparkSession
    _below(_loads(spark, root).last()[1], sequence)
    folders = {name: f"{name}/load-{sequence}-{uuid.uuid4().hex}" for name in LOAD_ORDER if name != POINTER}

    def write(name: str) -> DataFrame:
        payloads[name].withColumn("load_sequence", F.lit(sequence).cast("long")).write.parquet(f"{root}/{folders[name]}")
        return spark.read.parquet(f"{root}/{folders[name]}")

    with ThreadPoolExecutor(WRITERS) as pool:  # tables are independent until the log shows them
        written = dict(zip(folders, pool.map(write, folders), strict=True))
    written[POINTER] = payloads[POINTER]
    found = _checked(written)
    if callable(gates):
        gates = gates(written)
        require_gates(gates)
    releases = written["publish.releases"].select(F.col("id").alias("release_id"), "status")
    pointers = written[POINTER].select("spec_family", "release_id").join(releases, "release_id", "left").collect()  # a row a family
    if lost := [x["release_id"] for x in pointers if x["status"] is None]:
        raise ValueError(f"the pointer names releases that aren't in the load: {lost}")
    entry = _loads(spark, root).change(lambda last: {"loads": [*_below(last, sequence), {"sequence": sequence, "tables": folders}]})
    if len(entry["loads"]) > MOST_LOADS:
        compact(spark, root)
    for x in pointers:
        if x["status"] == "published":
            publish(spark, root, x["spec_family"], x["release_id"], x["status"], gates, published_at, sequence, again=True)
    return found


def _folders(spark: SparkSession, root: str, loads: list[dict], name: str, schema: StructType | None) -> DataFrame:
    """All rows of a table in some loads. Without a schema the newest load's columns are read."""
    parts = [f"{root}/{x['tables'][name]}" for x in loads]
    if schema is None:
        if not parts:
            raise ValueError(f"nothing is loaded into {name}")
        schema = spark.read.parquet(parts[-1]).schema
    schema = StructType([f for f in schema if f.name != "load_sequence"]).add("load_sequence", "long")
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def loaded(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a loaded table: of each key that of the highest load. The pointer's are those of `active`."""
    if name == POINTER:
        return active(spark, root)
    entry = _loads(spark, root).last()[1]
    rows = _folders(spark, root, entry["loads"] if entry else [], name, schema)
    return last_wins(rows, [load_key(name)], "load_sequence").drop("load_sequence")


def compact(spark: SparkSession, root: str) -> None:
    """Puts one folder a table, with the newest row of each key, in the place of those of all loads so far."""
    entry = _loads(spark, root).last()[1]
    if not entry or len(entry["loads"]) < 2:
        return
    old, folders = entry["loads"], {}
    for name in old[-1]["tables"]:
        folders[name] = f"{name}/merged-{old[-1]['sequence']}-{uuid.uuid4().hex}"
        last_wins(_folders(spark, root, old, name, None), [load_key(name)], "load_sequence").write.parquet(f"{root}/{folders[name]}")

    def make(last: dict) -> dict:
        if last["loads"][: len(old)] != old:  # a load was done again meanwhile
            return last
        return {"loads": [{"sequence": old[-1]["sequence"], "tables": folders}, *last["loads"][len(old) :]]}

    _loads(spark, root).change(make)


def publish(
    spark: SparkSession, root: str, family: str, release_id: str, status: str, gates: DataFrame, published_at: datetime | None, sequence: int, expected: str | None = None, again: bool = False
) -> DataFrame:
    """Moves the family's pointer to a release, last of all: only for published releases with gates that all pass. Nothing else moves it.

    No gates at all, or a gate without status, is refused too. The pointer is a log whose entries are created exclusively: a publisher decides on the last
    entry and makes the next one, or decides again on what another has made meanwhile. The sequence number must be above the
    family's last one, so of two publishers with one number exactly one succeeds, and neither a clock that steps back nor one who comes late revives an old
    release. With `expected`, the release that is active must be that one. With `again`, the same release under the same number is no error.
    """
    if status != "published":
        raise ValueError("only a published release can be active")
    require_gates(gates)

    def make(last: dict | None) -> dict:
        families = dict(last["families"]) if last else {}
        old = families.get(family)
        if old and again and (old["sequence"], old["release_id"]) == (sequence, release_id):
            return last
        if old and sequence <= old["sequence"]:
            raise ValueError(f"sequence {sequence} isn't above {old['sequence']}")
        if expected is not None and (old or {}).get("release_id") != expected:
            raise ValueError(f"{(old or {}).get('release_id')} is active, not {expected}")
        at = None if published_at is None else published_at.isoformat()
        return {"families": families | {family: {"release_id": release_id, "published_at": at, "sequence": sequence}}}

    Log(spark, f"{root}/{POINTER}").change(make)
    return active(spark, root)


def _pointer(spark: SparkSession, root: str) -> DataFrame:
    entry = Log(spark, f"{root}/{POINTER}").last()[1]
    rows = [(f, x["release_id"], x["published_at"] and datetime.fromisoformat(x["published_at"]), x["sequence"]) for f, x in sorted((entry or {"families": {}})["families"].items())]
    return spark.createDataFrame(rows, POINTER_ROW)


def active(spark: SparkSession, root: str) -> DataFrame:
    """(spec_family, release_id): the active release of each family."""
    return _pointer(spark, root).select("spec_family", "release_id")


def replace_partitions(df: DataFrame, path: str, by: list[str], apply: bool = False) -> DataFrame:
    """Rows of each partition; with `apply` only those partitions that `df` has rows of are written anew, others stay."""
    if apply:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def append_evidence(df: DataFrame, path: str, apply: bool = False) -> DataFrame:
    """The number of rows; with `apply` they are appended."""
    if apply:
        df.write.mode("append").parquet(path)
    return table_counts({path.rstrip("/").rpartition("/")[2]: df})


def wrong_paths(docs: DataFrame, actual: str, desired) -> DataFrame:
    """Files whose place isn't the one that their document asks for."""
    return docs.withColumn("desired_path", desired).where(~F.col(actual).eqNullSafe(F.col("desired_path")))


def snapshot(tables: dict[str, DataFrame], folder: str, apply: bool = False) -> DataFrame:
    """Row counts of the tables; with `apply` each is written to a new folder."""
    if apply:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{folder}/{name}")
    return table_counts(tables)


# --- serving views


def current(catalog: DataFrame, pointer: DataFrame, keys=("spec_family", "release_id")) -> DataFrame:
    """Rows of the active releases. The pointer has a row a family."""
    return catalog.join(F.broadcast(pointer.select(*keys)), list(keys))


def current_children(children: DataFrame, configs: DataFrame, pointer: DataFrame) -> DataFrame:
    parents = current(configs, pointer).select("config_id", "slash_sheet", "example_pin")
    return children.join(parents, "config_id")


def current_torque(links: DataFrame, docs: DataFrame, profiles: DataFrame, facts: DataFrame, pointer: DataFrame) -> DataFrame:
    d = docs.select("document_id", "spec_family", "slash_sheet", "spec_sheet")
    return current(links.join(d, "document_id"), pointer).join(profiles.drop("release_id"), "profile_id").join(facts.drop("release_id"), "profile_id")


def current_documents(docs: DataFrame, configs: DataFrame, pointer: DataFrame) -> DataFrame:
    """Documents with a configuration in their family's active release: a semi join, no distinct."""
    keys = ["spec_family", "document_id"]
    listed = configs.select("document_id", "release_id").join(F.broadcast(pointer.select("spec_family", "release_id")), "release_id")
    return docs.join(listed, keys, "left_semi")


def register_views(tables: dict[str, DataFrame], prefix: str = "v_catalog_") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
