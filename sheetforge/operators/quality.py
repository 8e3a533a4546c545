"""Checks, scores, gates and verdicts as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from .dims import CAVITIES
from .relational import only_left

CHECK = "struct<status:string,code:string,details:string>"


def _check(when: Column, status: str, code: str, details: Column | None = None) -> Column:
    return F.when(when, F.struct(F.lit(status).alias("status"), F.lit(code).alias("code"), (details if details is not None else F.lit(None).cast("string")).alias("details")))


def _codes(a: Column) -> Column:
    return F.array_join(a, ",")


def validation_checks(docs: DataFrame) -> DataFrame:
    """Adds `checks` and `flags` to documents.

    Columns: document_type, cavity_counts, n_configs, empty_cavities (cavities of rows without dimensions), inserts and finishes
    (codes in order), wire_codes, bleed_codes; from the dimensions expected_cavities, min_configs, min_inserts, min_wires,
    expected_inserts, expected_finishes (null: nothing expected).
    """
    missing = F.array_except("expected_cavities", "cavity_counts")
    wanted = F.size("expected_cavities") > 0
    codes = F.transform("wire_codes", lambda x: x.cast("int"))
    full = F.when(F.size(codes) > 0, F.sequence(F.array_min(codes), F.array_max(codes)))
    gaps = F.coalesce(F.array_except(full, codes), F.array().cast("array<int>"))
    pcb = F.col("document_type") == "pcb_tail"

    def compared(actual: str, expected: str, bad: str, good: str) -> list[Column]:
        known = F.col(expected).isNotNull()
        detail = F.concat(F.lit("missing="), _codes(F.array_except(expected, actual)), F.lit(" extra="), _codes(F.array_except(actual, expected)))
        return [_check(known & (F.col(actual) != F.col(expected)), "fail", bad, detail), _check(known & (F.col(actual) == F.col(expected)), "pass", good)]

    checks = [
        _check(wanted & (F.size(missing) > 0), "fail", "missing_expected_cavity_counts", _codes(missing.cast("array<string>"))),
        _check(wanted & (F.size(missing) == 0), "pass", "expected_cavity_counts_present"),
        _check((F.col("min_configs") > 0) & (F.col("n_configs") < F.col("min_configs")), "fail", "too_few_configuration_rows"),
        _check(pcb & (F.size("empty_cavities") > 0), "warn", "empty_configuration_dimensions"),
        _check((F.col("min_inserts") > 0) & (F.size("inserts") < F.col("min_inserts")), "fail", "too_few_insert_arrangements"),
        *compared("inserts", "expected_inserts", "unexpected_insert_arrangements", "expected_insert_arrangements_present"),
        *compared("finishes", "expected_finishes", "unexpected_shell_finish_codes", "expected_shell_finish_codes_present"),
        _check((F.col("min_wires") > 0) & (F.size("wire_codes") < F.col("min_wires")), "fail", "too_few_wire_options"),
        _check(F.size(gaps) > 0, "warn", "wire_code_gaps", _codes(gaps.cast("array<string>"))),
        _check(F.size("bleed_codes") > 0, "warn", "note_footer_bleed", _codes(F.col("bleed_codes"))),
    ]
    found = F.filter(F.array(*checks), lambda x: x.isNotNull())
    clear = F.array(_check(F.lit(True), "pass", "deterministic_validation_clear"))
    out = docs.withColumn("checks", F.when(F.size(found) > 0, found).otherwise(clear))
    bad = F.filter("checks", lambda x: x["status"] != "pass")
    return out.withColumn("flags", F.array_sort(F.array_distinct(F.transform(bad, lambda x: x["code"]))))


def confidence(docs: DataFrame) -> DataFrame:
    """Adds `score`, `confidence` (two decimals, half to even) and `needs_fallback` to documents with `flags`.

    Columns besides those of validation_checks: present (names of fields that are there), required, expected_headers, headers,
    n_pages. The decision uses the unrounded score.
    """
    lost = F.size(F.array_except("required", "present")) * F.lit(0.12)
    structured = F.array(F.lit("configuration_rows"), F.lit("pin_components"), F.lit("figure_references"))
    structured = F.when(F.col("min_wires") > 0, F.concat(structured, F.array(F.lit("wire_options")))).otherwise(structured)
    plug = F.when(F.col("document_type") == "plug_receptacle", F.size(F.array_except(structured, F.col("present"))) * F.lit(0.08)).otherwise(0.0)
    absent = F.size(F.filter("expected_headers", lambda h: ~F.exists("headers", lambda x: x.contains(h)))) * F.lit(0.03)
    part = lambda cond, v: F.when(cond, v).otherwise(0.0)
    few = lambda least, n: (F.col(least) > 0) & (n < F.col(least))
    missing = (F.size("expected_cavities") > 0) & (F.size(F.array_except("expected_cavities", "cavity_counts")) > 0)
    illegal = F.size(F.array_except("cavity_counts", F.array(*[F.lit(c) for c in CAVITIES]))) > 0
    raw = (
        F.lit(1.0) - lost - plug - part(missing, 0.20) - part(few("min_configs", F.col("n_configs")), 0.12) - part(few("min_inserts", F.size("inserts")), 0.10)
        - part(few("min_wires", F.size("wire_codes")), 0.10) - absent - part(illegal, 0.20)
    )
    out = docs.withColumn("score", F.when(F.col("n_pages") == 0, 0.0).otherwise(F.greatest(raw, F.lit(0.0))))
    return out.withColumn("confidence", F.bround("score", 2)).withColumn("needs_fallback", (F.col("score") < 0.85) | (F.size("flags") > 0))


def identity(docs: DataFrame, first_page: str = "first_page", given: str = "spec_sheet") -> DataFrame:
    """The spec number of the first page wins over the given one, with a warning where they differ."""
    out = docs.withColumn("detected_spec_sheet", t.spec_header(first_page))
    found = F.col("detected_spec_sheet")
    out = out.withColumn("identity_warning", found.isNotNull() & ~found.eqNullSafe(F.col(given)))
    return out.withColumn(given, F.coalesce(found, F.col(given)))


# --- gates


def gate(df: DataFrame, name: str, ok: Column, details: Column | None = None) -> DataFrame:
    """One row (name, status, details) from aggregates over `df`."""
    d = details.cast("string") if details is not None else F.lit(None).cast("string")
    return df.agg(F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("fail").alias("status"), d.alias("details")).select(F.lit(name).alias("name"), "status", "details")


def counts_gate(actual: DataFrame, key: str, expected: DataFrame, name: str) -> DataFrame:
    """One row for each expected (key, n): whether `actual` has so many rows. `name` is a format with the key and the count."""
    counted = actual.groupBy(key).agg(F.count("*").alias("actual"))
    got = F.coalesce("actual", F.lit(0))
    return F.broadcast(expected).join(counted, key, "left").select(
        F.format_string(name, key, F.col("n").cast("string")).alias("name"), F.when(got == F.col("n"), "pass").otherwise("fail").alias("status"), F.concat(F.lit("actual="), got).alias("details")
    )


def sets_gate(actual: DataFrame, key: str, code: str, expected: DataFrame, name: str) -> DataFrame:
    """One row for each expected (key, codes): whether the sorted distinct codes agree; null codes count as none."""
    got = actual.groupBy(key).agg(F.array_sort(F.collect_set(code)).alias("actual"))
    have = F.coalesce("actual", F.array().cast("array<string>"))
    return F.broadcast(expected).join(got, key, "left").select(
        F.format_string(name, key).alias("name"), F.when(have == F.col("codes"), "pass").otherwise("fail").alias("status"), F.concat(F.lit("actual="), _codes(have)).alias("details")
    )


def mismatches(manifest: DataFrame, extracted: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Rows whose hashes differ on both sides of a key."""
    return manifest.select(key, a).join(extracted.select(key, b), key).where(~F.col(a).eqNullSafe(F.col(b)))


def all_green(gates: DataFrame, mode: Column | str = "fresh") -> DataFrame:
    """One row: whether every gate passes and the run is a fresh one."""
    fresh = (F.lit(mode) if isinstance(mode, str) else mode) == "fresh"
    return gates.agg((F.coalesce(F.bool_and(F.col("status") == "pass"), F.lit(False)) & F.first(fresh)).alias("may_promote"), F.count_if(F.col("status") != "pass").alias("n_failed"), F.count("*").alias("n_gates"))


def require_green(gates: DataFrame, mode: str = "fresh") -> DataFrame:
    """The gates, with an error when read if one fails or the run isn't fresh."""
    state = all_green(gates, mode)
    return gates.crossJoin(F.broadcast(state)).where(F.assert_true(F.col("may_promote"), F.lit("not every gate passes on a fresh run")).isNull()).select(*gates.columns)


def release_gates(spark: SparkSession, manifest: DataFrame, runs: DataFrame, records: DataFrame, configs: DataFrame, wires: DataFrame, profiles: DataFrame, facts: DataFrame, links: DataFrame) -> DataFrame:
    """The 32 acceptance gates of a release.

    manifest (slash_sheet, checksum, spec_sheet, doc_id), runs (slash_sheet, returncode), records (slash_sheet, flags, source_sha256), configs
    (slash_sheet, insert_code, finish_code), wires (slash_sheet), profiles (profile_id, profile_code, kind), facts (profile_id, thread, scope), links
    (slash_sheet, profile_id, mapping_type, values_inherited, values_verified).
    """
    from . import dims

    frame = lambda d: spark.createDataFrame([(k, v) for k, v in d.items()], "slash_sheet string, n int")
    codes = lambda d: spark.createDataFrame([(k, list(v)) for k, v in d.items()], "slash_sheet string, codes array<string>")
    main = profiles.where(F.col("profile_code") == dims.MAIN).select("profile_id", "kind")
    own = facts.join(F.broadcast(main), "profile_id")
    out = [
        gate(manifest, "all 34 documents selected", F.count("*") == 34, F.count("*")),
        gate(manifest, "all source hashes logged", F.count_if(F.coalesce("checksum", F.lit("")) == "") == 0),
        gate(manifest.where("slash_sheet = '02'"), "latest /02 is its fourth amendment", F.max(F.upper("doc_id")).startswith("MIL-DTL-83513/2H(4)") & (F.max("spec_sheet") == "MIL-DTL-83513/2H"), F.max("doc_id")),
        gate(runs, "no failed extractions", F.count_if(F.col("returncode") != 0) == 0),
        gate(records, "no unexpected inserts or finishes", F.count_if(F.arrays_overlap("flags", F.array(F.lit("unexpected_insert_arrangements"), F.lit("unexpected_shell_finish_codes")))) == 0),
        gate(mismatches(manifest, records, "slash_sheet", "checksum", "source_sha256"), "no stale sources", F.count("*") == 0, F.count("*")),
        counts_gate(configs, "slash_sheet", frame(dims.CONFIG_COUNTS), "/%s has %s configurations"),
        sets_gate(configs, "slash_sheet", "insert_code", codes({k: dims.INSERTS[k[1]] for k in ("02", "04")}), "/%s has the expected inserts"),
        sets_gate(configs, "slash_sheet", "finish_code", codes({k: "" for k in dims.CLASS_P}), "/%s has no finish codes"),
        sets_gate(configs, "slash_sheet", "finish_code", codes({k: "ACKNPT" for k in dims.CLASS_M}), "/%s has all six finishes"),
        counts_gate(wires, "slash_sheet", frame(dims.WIRE_COUNTS), "/%s has %s wires"),
        gate(
            links.where("slash_sheet = '05'").join(main, "profile_id"), "/05 owns the canonical profile",
            (F.count_if((F.col("mapping_type") == "uses_profile") & (F.col("kind") == "canonical")) > 0) & F.lit(True),
        ).join(own.agg((F.count("*") == 6).alias("six")), how="cross").select("name", F.when(F.col("six"), F.col("status")).otherwise("fail").alias("status"), "details"),
        *[
            gate(links.where(F.col("slash_sheet") == s).join(main, "profile_id"), f"/{s} inherits /05", F.bool_and((F.col("mapping_type") == "references_profile") & F.col("values_inherited") & F.col("values_verified")))
            for s in ("02", "04")
        ],
        gate(own.where("(thread, scope) in (('#2-56', 'Metal shell'), ('#2-56', 'Plastic shell'), ('#4-40', 'Metal shell'))"), "/05 covers both threads and shells", F.count_distinct("thread", "scope") == 3),
    ]
    return reduce(DataFrame.unionByName, out)


# --- rebuild


def summary_by_sheet(rows: DataFrame, wires: DataFrame) -> DataFrame:
    """Rows, rows without example, distinct inserts, finishes and cavities, and wires of each sheet. Wires are counted before the join."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = rows.groupBy("slash_sheet").agg(
        F.count("*").alias("base_rows"), F.count_if(F.coalesce("example_pin", F.lit("")) == "").alias("without_example"), joined("insert_code").alias("inserts"),
        joined("finish_code").alias("finishes"), F.array_join(F.transform(F.array_sort(F.collect_set("cavity_count")), lambda x: x.cast("string")), ",").alias("cavities"),
    )
    return base.join(wires.groupBy("slash_sheet").agg(F.count("*").alias("wire_rows")), "slash_sheet", "left").withColumn("wire_rows", F.coalesce("wire_rows", F.lit(0)))


def edge_checks(spark: SparkSession, summary: DataFrame, resolved: DataFrame) -> DataFrame:
    """The 21 checks of a rebuild: expected counts and sets against the summary, and what the resolver says of /02, /04 and /05."""
    from . import dims

    def compare(expected: dict, column: str, name: str) -> DataFrame:
        want = spark.createDataFrame([(k, str(v)) for k, v in expected.items()], "slash_sheet string, want string")
        got = F.coalesce(F.col(column).cast("string"), F.lit("0" if column.endswith("rows") else ""))
        return F.broadcast(want).join(summary, "slash_sheet", "left").select(F.format_string(name, "slash_sheet", "want").alias("name"), F.when(got == F.col("want"), "pass").otherwise("fail").alias("status"), got.alias("details"))

    one = lambda s, name, ok: gate(resolved.where(F.col("slash_sheet") == s), name, F.bool_and(ok), F.count("*"))
    inherits = (F.col("fact_count") == 6) & F.col("values_inherited") & F.col("values_verified") & ~F.col("needs_review")
    out = [
        compare(dims.CONFIG_COUNTS, "base_rows", "/%s has %s staged rows"),
        compare({k: ",".join(dims.INSERTS[k[1]]) for k in ("02", "04")}, "inserts", "/%s has inserts %s"),
        compare(dims.WIRE_COUNTS, "wire_rows", "/%s has %s staged wires"),
        one("02", "/02 inherits verified torque", inherits),
        one("04", "/04 inherits verified torque", inherits),
        one("05", "/05 owns six facts", (F.col("fact_count") == 6) & (F.col("torque_mode") == "owns_profile")),
        compare({k: "" for k in dims.CLASS_P}, "finishes", "/%s has finishes %s"),
    ]
    return reduce(DataFrame.unionByName, out)


def source_checks(documents: DataFrame, extracted: DataFrame, sheet: str = "02") -> DataFrame:
    """Three checks: every document was extracted, its spec sheet agrees, and its bytes are those of the inventory."""
    both = documents.join(extracted, "slash_sheet", "left")
    return (
        gate(both, "every document has an extraction", F.count_if(F.col("source_sha256").isNull()) == 0)
        .unionByName(gate(both, "spec sheets agree", F.count_if(~F.col("spec_sheet").eqNullSafe(F.col("extracted_spec_sheet"))) == 0))
        .unionByName(gate(both.where(F.col("slash_sheet") == sheet), f"/{sheet} was extracted from the stored bytes", F.bool_and(F.col("checksum") == F.col("source_sha256"))))
    )


def parity_checks(legacy: DataFrame, resolved: DataFrame, effective: DataFrame) -> DataFrame:
    """The seven checks before serving changes over to resolved torque.

    legacy (slash_sheet): rows of the old values; resolved (slash_sheet, profile_id, fact_count, values_verified, profile_status, needs_review);
    effective (slash_sheet, fact_key). A sheet that isn't there fails the check that names it.
    """
    facts = effective.groupBy("slash_sheet").agg(F.count("*").alias("n_facts"), F.array_sort(F.collect_set("fact_key")).alias("facts"))  # a profile has a handful
    return parity_by_sheet(legacy, resolved, facts)


#: Checks of parity look at the facts themselves of sheets that have so many at most.
PARITY_FACTS = 6


def parity_by_sheet(legacy: DataFrame, resolved: DataFrame, facts: DataFrame) -> DataFrame:
    """As `parity_checks`, over what each sheet has: facts (slash_sheet, n_facts, facts), the array null where it would have more than PARITY_FACTS."""
    from . import dims

    spark = resolved.sparkSession
    sheets = lambda names: F.broadcast(spark.createDataFrame([(s,) for s in names], "slash_sheet string"))
    counted = resolved.groupBy("slash_sheet").agg(F.sum("fact_count").alias("want")).join(facts, "slash_sheet", "left")
    main = facts.where(F.col("slash_sheet") == "05").agg(F.first("facts").alias("main"))
    flags = resolved.groupBy("slash_sheet").agg(
        F.bool_and(F.coalesce("values_verified", F.lit(False))).alias("verified"), F.bool_and(F.coalesce(F.col("profile_status") == "provisional", F.lit(False))).alias("provisional")
    )
    named = lambda names: sheets(names).join(facts, "slash_sheet", "left").join(flags, "slash_sheet", "left")
    inheriting = named(dims.INHERITING).crossJoin(F.broadcast(main))  # one row
    six = (F.size("facts") == 6) & F.col("facts").eqNullSafe(F.col("main")) & F.col("verified")
    two = (F.size("facts") == 2) & F.col("provisional")
    own = resolved.where("slash_sheet = '08'").select("profile_id")
    out = [
        gate(only_left(legacy, resolved, ["slash_sheet"]), "old values are all resolved", F.count("*") == 0, F.count("*")),
        gate(counted, "fact counts are those of the effective facts", F.count_if(F.coalesce("n_facts", F.lit(0)) != F.col("want")) == 0),
        gate(inheriting, "inheriting sheets have the six verified facts of /05", F.count_if(six) == len(dims.INHERITING), F.count_if(six)),
        gate(named(dims.BOARD), "board sheets share two provisional facts", (F.count_if(two) == len(dims.BOARD)) & (F.count_distinct("facts") == 1), F.count_if(two)),
        gate(resolved.join(own.distinct(), "profile_id", "left_semi"), "/08 is isolated", F.count_distinct("slash_sheet") == 1),
        gate(resolved.where("slash_sheet = '08'"), "/08 needs review", F.bool_and("needs_review")),
        gate(facts.where("slash_sheet = 'base'"), "base has no effective facts", F.coalesce(F.sum("n_facts"), F.lit(0)) == 0, F.coalesce(F.sum("n_facts"), F.lit(0))),
    ]
    return reduce(DataFrame.unionByName, out)


def no_regression(live: DataFrame, staged: DataFrame, field: str = "wire_range") -> DataFrame:
    """One check: staged rows miss the field no more often than live ones. Both sides: (field, n_missing)."""
    a = live.where(F.col("field") == field).agg(F.coalesce(F.sum("n_missing"), F.lit(0)).alias("live"))
    b = staged.where(F.col("field") == field).agg(F.coalesce(F.sum("n_missing"), F.lit(0)).alias("staged"))
    return a.crossJoin(b).select(F.lit(f"staged missing {field} doesn't grow").alias("name"), F.when(F.col("staged") <= F.col("live"), "pass").otherwise("fail").alias("status"), F.concat_ws("/", "live", "staged").alias("details"))


# --- golden cases


def golden_verdicts(cases: DataFrame, returned: DataFrame) -> DataFrame:
    """cases (case_id, valid, invalid) against returned (case_id, slash_sheet) rows: false positives and negatives, hits on sheets that
    must not come, and whether sheets came more than once. A case without any returned row is unresolved."""
    got = returned.groupBy("case_id").agg(F.array_sort(F.collect_set("slash_sheet")).alias("got"), F.count("slash_sheet").alias("n_rows"))
    empty = F.array().cast("array<string>")
    out = cases.join(got, "case_id", "left").withColumn("resolved", F.col("got").isNotNull()).withColumn("got", F.coalesce("got", empty))
    out = out.withColumns({"false_positives": F.array_sort(F.array_except("got", "valid")), "false_negatives": F.array_sort(F.array_except("valid", "got")), "invalid_hits": F.array_sort(F.array_intersect("got", "invalid"))})
    wrong = F.size("false_positives") + F.size("false_negatives") + F.size("invalid_hits") > 0
    noisy = F.coalesce(F.col("n_rows") > F.size("got"), F.lit(False))
    return out.withColumn("verdict", F.when(~F.col("resolved"), "unresolved").when(wrong, "fail").when(noisy, "noisy_pass").otherwise("pass"))


def verdict_cases(verdicts: DataFrame) -> DataFrame:
    """(verdict, n, case_id): every case with how many have its verdict; counts are a row a verdict, and no ids are gathered."""
    counts = verdicts.groupBy("verdict").agg(F.count("*").alias("n"))
    return verdicts.select("verdict", "case_id").join(F.broadcast(counts), "verdict").select("verdict", "n", "case_id")  # five verdicts


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Counts and sorted ids of each verdict, in one row: for a report of few cases. `verdict_cases` has no such bound."""
    return verdicts.groupBy("verdict").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("case_id")), ",").alias("case_ids"))


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) of every row that breaks a rule; a rule that is null holds, as in a table check."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), name) for name, ok in rules.items()]))
    return df.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a null part makes rows distinct."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
