"""Shared torque facts: classification of documents, profiles, and the resolver in its three definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .ranges import FEW, in_ranges
from .relational import counts_with_zero, last_wins


#: So many facts of a profile go into one row of the join, and so many result rows into one task, about.
PACK, PER_TASK = 1000, 5_000_000


def by_rule(documents: DataFrame, rules: DataFrame, number: str) -> DataFrame:
    """The rules whose range holds the document's number, a row for each; documents without one stay, with nulls. A few rules are broadcast, more are joined by blocks."""
    if len(rules.select(F.lit(1)).head(FEW + 1)) <= FEW:
        return documents.join(F.broadcast(rules), F.col(number).between(F.col("lo"), F.col("hi")), "left").drop("lo", "hi")
    return in_ranges(documents, rules, number, how="left").drop("lo", "hi")


def classify(documents: DataFrame, torque_rows: DataFrame, rules: DataFrame) -> DataFrame:
    """One status row a document: profile, mapping, torque mode, audit status, number and time of its extracted rows.

    Documents outside the rules need a review if they have rows, and have mode `none`, pending, if they don't.
    """
    numbered = documents.withColumn("_n", F.expr("try_cast(slash_sheet as int)"))
    seen = torque_rows.groupBy("spec_sheet").agg(F.count("*").alias("extracted_row_count"), F.max("extracted_at").alias("last_extracted_at"))
    out = by_rule(numbered, rules, "_n").drop("_n").join(seen, "spec_sheet", "left")
    rows = F.coalesce("extracted_row_count", F.lit(0))
    return out.withColumns(
        {
            "extracted_row_count": rows,
            "torque_mode": F.coalesce("torque_mode", F.when(rows > 0, "needs_review").otherwise("none")),
            "audit_status": F.coalesce("audit_status", F.when(rows > 0, "needs_review").otherwise("pending")),
        }
    )


def profile_values(torque_rows: DataFrame, status: DataFrame) -> DataFrame:
    """Values of each profile: rows with both bounds of any document mapped to it, last wins on the fact key."""
    rows = torque_rows.where("min_in_lbf is not null and max_in_lbf is not null")
    rows = rows.join(status.select("spec_sheet", "profile_code"), "spec_sheet").where("profile_code is not null")
    key = text.fact_key(F.col("context"), F.coalesce("thread", F.lit("")), F.coalesce("scope", F.lit("")), F.col("min_in_lbf").cast("string"), F.col("max_in_lbf").cast("string"))
    return last_wins(rows.withColumn("fact_key", key), ["profile_code", "fact_key"], "ordinal")


def _flags(definition: str) -> tuple[Column, Column, Column]:
    """(verified, inherited, needs review) in the serving view's, the staging check's or the release's definition."""
    approved = F.col("approval_status") == "approved"
    none = F.col("profile_id").isNull()
    reference, shared = F.col("mapping_type") == "references_profile", F.col("kind") == "shared_derived"
    if definition == "view":
        inherited = F.when(none, False).when(reference, True).when(shared, True).when(F.col("spec_sheet") != F.col("source_spec_sheet"), True).otherwise(False)
        review = (
            F.when(none & ~F.col("torque_mode").isin("none", "no_torque"), True)
            .when(F.col("audit_status").isin("needs_review", "stale"), True)
            .when(F.col("approval_status").isin("needs_review", "rejected"), True)
            .when(F.col("profile_status").isin("unverified", "provisional"), True)
            .otherwise(False)
        )
        return approved & (F.col("truth_level") == "audited_pdf_table"), inherited, review
    no = lambda c: F.coalesce(c, F.lit(False))
    if definition == "staged":
        review = no(F.col("audit_status") == "needs_review") | no(F.col("approval_status").isin("needs_review", "rejected", "pending"))
        return no(approved), no(reference) | no(shared), review
    if definition == "release":
        return no(approved) | no(F.col("profile_status") == "verified"), no(reference), no(F.col("audit_status") == "needs_review")
    raise ValueError("definition is view, staged or release")


def resolve(status: DataFrame, mapping: DataFrame, profiles: DataFrame, facts: DataFrame, evidence: DataFrame, definition: str = "view") -> DataFrame:
    """Each document with its profile, counts of facts and evidence, and the three flags.

    status (spec_sheet, torque_mode, audit_status), mapping (spec_sheet, profile_id, mapping_type), profiles (profile_id, kind,
    profile_status, truth_level, approval_status, source_spec_sheet), facts (profile_id), evidence (spec_sheet).
    Counts are taken before the joins; a document with two mappings gives two rows.
    """
    n_facts = facts.groupBy("profile_id").agg(F.count("*").alias("fact_count"))
    n_evidence = evidence.groupBy("spec_sheet").agg(F.count("*").alias("evidence_count"))
    joined = (
        status.join(mapping, "spec_sheet", "left")
        .join(profiles.withColumn("_p", F.col("profile_id")), "profile_id", "left")
        .withColumn("profile_id", F.col("_p"))
        .drop("_p")
        .join(n_facts, "profile_id", "left")
        .join(n_evidence, "spec_sheet", "left")
    )
    verified, inherited, review = _flags(definition)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.withColumns(
        {
            "fact_count": zero("fact_count"),
            "evidence_count": zero("evidence_count"),
            "has_numeric_values": zero("fact_count") > 0,
            "values_verified": verified,
            "values_inherited": inherited,
            "needs_review": review,
        }
    )


def effective(resolved: DataFrame, profiles: DataFrame, facts: DataFrame) -> DataFrame:
    """A row for each document and fact of its active profile.

    The result grows with documents times facts of a profile. Facts are packed, PACK a row, and each document meets every pack of its profile, so that a profile
    is dealt over tasks, whose number follows from the number of rows that come out (one number to the driver).
    """
    own = [c for c in facts.columns if c not in resolved.columns]
    kept = ["profile_id", *[c for c in resolved.columns if c != "profile_id"]]
    sizes = facts.groupBy("profile_id").agg(F.count("*").alias("_n")).withColumn("_packs", F.expr(f"(_n + {PACK - 1}) div {PACK}"))
    active = profiles.where("is_active").select("profile_id").join(sizes, "profile_id")
    docs = resolved.where("profile_id is not null").join(active, "profile_id")
    tasks = max(1, min(10_000, (docs.agg(F.sum("_n")).first()[0] or 0) // PER_TASK))
    pack = F.pmod(F.xxhash64(*own) if own else F.lit(0), F.col("_packs")).alias("_pack")
    packed = facts.join(sizes, "profile_id").select("profile_id", pack, F.struct(F.lit(True).alias("_there"), *own).alias("_fact")).groupBy("profile_id", "_pack").agg(F.collect_list("_fact").alias("_facts"))
    asked = docs.select(*kept, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_packs") - 1)).alias("_pack"))
    if tasks > 1:
        asked, packed = asked.repartition(tasks, "profile_id", "_pack"), packed.repartition(tasks, "profile_id", "_pack")
    return asked.join(packed, ["profile_id", "_pack"]).select(*kept, F.explode("_facts").alias("_fact")).select(*kept, *[F.col("_fact")[c].alias(c) for c in own])


def effective_by_sheet(resolved: DataFrame, profiles: DataFrame, facts: DataFrame, largest: int) -> DataFrame:
    """(slash_sheet, n_facts, facts): what `effective` has for each sheet, from counts of documents and of facts by profile.

    facts is the sorted array of the sheet's distinct fact keys if none of its profiles has more than `largest` of them, else null: such a sheet has more than `largest`.
    """
    active = profiles.where("is_active").select("profile_id")
    documents = resolved.where("profile_id is not null").join(active, "profile_id").groupBy("slash_sheet", "profile_id").agg(F.count("*").alias("_docs"))
    sizes = facts.groupBy("profile_id").agg(F.count("*").alias("_n"), F.count_distinct("fact_key").alias("_keys"))
    both = documents.join(sizes, "profile_id")
    sheets = both.groupBy("slash_sheet").agg(F.sum(F.col("_docs") * F.col("_n")).alias("n_facts"), F.max("_keys").alias("_most"))
    small = both.where(F.col("_keys") <= largest).join(sheets.where(F.col("_most") <= largest).select("slash_sheet"), "slash_sheet", "left_semi").select("slash_sheet", "profile_id")
    few = facts.join(sizes.where(F.col("_keys") <= largest), "profile_id", "left_semi").select("profile_id", "fact_key").distinct()
    sets = small.join(few, "profile_id").groupBy("slash_sheet").agg(F.array_sort(F.collect_set("fact_key")).alias("facts"))
    return sheets.select("slash_sheet", "n_facts").join(sets, "slash_sheet", "left")


def fact_counts(profiles: DataFrame, facts: DataFrame) -> DataFrame:
    return counts_with_zero(profiles, facts, "profile_id", "fact_count")


def review_queue(resolved: DataFrame) -> DataFrame:
    """Documents to look at: flagged, on a provisional profile, changed since approval, unmapped, or governed by another revision."""
    why = F.array_compact(
        F.array(
            F.when(F.col("needs_review"), "needs review"),
            F.when(F.col("profile_status") == "provisional", "provisional profile"),
            F.when(F.col("last_extracted_at") > F.col("approved_at"), "evidence changed after approval"),
            F.when(F.col("profile_id").isNull() & ~F.col("torque_mode").isin("none", "no_torque"), "unresolved mapping"),
            F.when(F.col("governing_revision") != F.col("current_revision"), "governing revision differs"),
        )
    )
    return resolved.withColumn("why", why).where(F.size("why") > 0)


def promotion_outcome(has_evidence: Column, has_profile: Column, audited: Column, rejected: Column) -> Column:
    """The outcome of a promotion."""
    return (
        F.when(rejected, "reject_candidate")
        .when(has_evidence & audited & ~has_profile, "approve_canonical_profile")
        .when(has_evidence & has_profile, "map_existing_profile")
        .when(has_evidence & audited, "approve_canonical_profile")
        .when(has_evidence, "provisional_profile")
        .otherwise("evidence_only")
    )
