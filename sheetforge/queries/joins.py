"""Joins: children, resolvers, releases, mates, rules, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as v
from ..operators import dims, extract, quality, search, torque, variants
from ..operators.relational import changed, count_diff, gaps, is_subset, only_left, table_counts
from ..plans import release, views
from ..sources.tables import table
from .base import PARTS_SQL, configurations, query


@query("SELECT l_orderkey, l_linenumber, p_partkey, p_brand, l_quantity FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size > 40")
def j_inner_child(spark, d):
    p = table(spark, d, "part").where("p_size > 40").select("p_partkey", "p_brand")
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity")
    return p.join(li, "p_partkey").select("l_orderkey", "l_linenumber", "p_partkey", "p_brand", "l_quantity")


def _torque_tables(spark, d):
    """supplier, nation, customer and orders as status, profiles, facts and evidence."""
    s = table(spark, d, "supplier")
    status = s.select(F.col("s_name").alias("spec_sheet"), F.when(F.col("s_suppkey") % 4 == 0, "none").otherwise("references_other_doc").alias("torque_mode"), F.when(F.col("s_acctbal") < 0, "needs_review").otherwise("pending").alias("audit_status"))
    mapping = s.where("s_suppkey % 5 != 0").select(F.col("s_name").alias("spec_sheet"), F.col("s_nationkey").alias("profile_id"), F.when(F.col("s_suppkey") % 3 == 0, "references_profile").otherwise("uses_profile").alias("mapping_type"))
    k = F.col("n_nationkey")
    profiles = table(spark, d, "nation").where("n_nationkey < 22").select(
        k.alias("profile_id"), F.when(k % 3 == 0, "canonical").otherwise("shared_derived").alias("kind"), F.when(k % 4 == 0, "provisional").otherwise("verified").alias("profile_status"),
        F.when(k % 2 == 0, "audited_pdf_table").otherwise("extracted_numeric_text").alias("truth_level"), F.when(k % 5 == 0, "needs_review").otherwise("approved").alias("approval_status"),
        F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0")).alias("source_spec_sheet"), (k % 6 != 0).alias("is_active"),
    )
    facts = table(spark, d, "customer").where("c_nationkey % 2 = 0").select(F.col("c_nationkey").alias("profile_id"), F.col("c_custkey").alias("fact_key"))
    evidence = table(spark, d, "orders").select(F.concat(F.lit("Supplier#"), F.lpad((F.col("o_custkey") % 80).cast("string"), 9, "0")).alias("spec_sheet"))
    return status, mapping, profiles, facts, evidence


_TORQUE_SQL = """
status AS (SELECT s_name AS spec_sheet, CASE WHEN s_suppkey % 4 = 0 THEN 'none' ELSE 'references_other_doc' END AS torque_mode, CASE WHEN s_acctbal < 0 THEN 'needs_review' ELSE 'pending' END AS audit_status FROM supplier),
mapping AS (SELECT s_name AS spec_sheet, s_nationkey AS profile_id, CASE WHEN s_suppkey % 3 = 0 THEN 'references_profile' ELSE 'uses_profile' END AS mapping_type FROM supplier WHERE s_suppkey % 5 <> 0),
profiles AS (SELECT n_nationkey AS profile_id, CASE WHEN n_nationkey % 3 = 0 THEN 'canonical' ELSE 'shared_derived' END AS kind, CASE WHEN n_nationkey % 4 = 0 THEN 'provisional' ELSE 'verified' END AS profile_status,
  CASE WHEN n_nationkey % 2 = 0 THEN 'audited_pdf_table' ELSE 'extracted_numeric_text' END AS truth_level, CASE WHEN n_nationkey % 5 = 0 THEN 'needs_review' ELSE 'approved' END AS approval_status,
  'Supplier#' || lpad(n_nationkey::VARCHAR, 9, '0') AS source_spec_sheet, n_nationkey % 6 <> 0 AS is_active FROM nation WHERE n_nationkey < 22),
facts AS (SELECT c_nationkey AS profile_id, c_custkey AS fact_key FROM customer WHERE c_nationkey % 2 = 0),
evidence AS (SELECT 'Supplier#' || lpad((o_custkey % 80)::VARCHAR, 9, '0') AS spec_sheet FROM orders),
fc AS (SELECT profile_id, count(*) AS n FROM facts GROUP BY profile_id), ec AS (SELECT spec_sheet, count(*) AS n FROM evidence GROUP BY spec_sheet),
resolved AS (
  SELECT d.spec_sheet, p.profile_id, m.mapping_type, coalesce(fc.n, 0) AS fact_count, coalesce(ec.n, 0) AS evidence_count, coalesce(fc.n, 0) > 0 AS has_numeric_values,
    p.approval_status = 'approved' AND p.truth_level = 'audited_pdf_table' AS values_verified,
    CASE WHEN p.profile_id IS NULL THEN FALSE WHEN m.mapping_type = 'references_profile' THEN TRUE WHEN p.kind = 'shared_derived' THEN TRUE WHEN d.spec_sheet <> p.source_spec_sheet THEN TRUE ELSE FALSE END AS values_inherited,
    CASE WHEN p.profile_id IS NULL AND d.torque_mode NOT IN ('none', 'no_torque') THEN TRUE WHEN d.audit_status IN ('needs_review', 'stale') THEN TRUE WHEN p.approval_status IN ('needs_review', 'rejected') THEN TRUE
      WHEN p.profile_status IN ('unverified', 'provisional') THEN TRUE ELSE FALSE END AS needs_review,
    d.torque_mode, d.audit_status, p.kind, p.profile_status, p.approval_status
  FROM status d LEFT JOIN mapping m ON m.spec_sheet = d.spec_sheet LEFT JOIN profiles p ON p.profile_id = m.profile_id
  LEFT JOIN fc ON fc.profile_id = p.profile_id LEFT JOIN ec ON ec.spec_sheet = d.spec_sheet
)
"""
_RESOLVED = ["spec_sheet", "profile_id", "mapping_type", "fact_count", "evidence_count", "has_numeric_values", "values_verified", "values_inherited", "needs_review"]


@query(f"WITH {_TORQUE_SQL} SELECT {', '.join(_RESOLVED)} FROM resolved")
def j_resolver(spark, d):
    return torque.resolve(*_torque_tables(spark, d)).select(*_RESOLVED)


@query(f"WITH {_TORQUE_SQL} SELECT r.spec_sheet, r.profile_id, f.fact_key, r.values_verified, r.needs_review FROM resolved r JOIN profiles p ON p.profile_id = r.profile_id AND p.is_active JOIN facts f ON f.profile_id = r.profile_id")
def j_effective(spark, d):
    status, mapping, profiles, facts, evidence = _torque_tables(spark, d)
    r = torque.resolve(status, mapping, profiles, facts, evidence).drop("is_active")
    return torque.effective(r, profiles, facts).select("spec_sheet", "profile_id", "fact_key", "values_verified", "needs_review")


@query(f"""
WITH {_TORQUE_SQL}
SELECT spec_sheet, values_verified AS view_verified, values_inherited AS view_inherited, needs_review AS view_review,
  coalesce(approval_status = 'approved', FALSE) AS staged_verified, coalesce(mapping_type = 'references_profile', FALSE) OR coalesce(kind = 'shared_derived', FALSE) AS staged_inherited,
  audit_status = 'needs_review' OR coalesce(approval_status IN ('needs_review', 'rejected', 'pending'), FALSE) AS staged_review,
  coalesce(approval_status = 'approved', FALSE) OR coalesce(profile_status = 'verified', FALSE) AS release_verified, coalesce(mapping_type = 'references_profile', FALSE) AS release_inherited
FROM resolved WHERE needs_review
""")
def q_review_queue(spark, d):
    """The three definitions of verified, inherited and review side by side, for rows to look at."""
    tables = _torque_tables(spark, d)
    out = torque.resolve(*tables)
    flags = {name: torque._flags(name) for name in ("view", "staged", "release")}
    v_, s_, r_ = flags["view"], flags["staged"], flags["release"]
    return out.where("needs_review").select(
        "spec_sheet", v_[0].alias("view_verified"), v_[1].alias("view_inherited"), v_[2].alias("view_review"), s_[0].alias("staged_verified"), s_[1].alias("staged_inherited"),
        s_[2].alias("staged_review"), r_[0].alias("release_verified"), r_[1].alias("release_inherited"),
    )


def _dated_tables(spark, d):
    """The torque tables with days of extraction and approval and with revisions."""
    status, mapping, profiles, facts, evidence = _torque_tables(spark, d)
    n = F.regexp_extract("spec_sheet", "([0-9]+)$", 1).cast("int")
    status = status.withColumn("last_extracted_at", n % 7).withColumn("current_revision", F.when(n % 2 == 0, "A").otherwise("B"))
    profiles = profiles.withColumn("approved_at", F.col("profile_id") % 5).withColumn("governing_revision", F.when(F.col("profile_id") % 3 == 0, "A").otherwise("B"))
    return status, mapping, profiles, facts, evidence


@query(f"""
WITH {_TORQUE_SQL}, q AS (SELECT spec_sheet, profile_id, concat_ws('; ', CASE WHEN needs_review THEN 'needs review' END, CASE WHEN profile_status = 'provisional' THEN 'provisional profile' END,
  CASE WHEN substr(spec_sheet, 10)::INT % 7 > profile_id % 5 THEN 'evidence changed after approval' END, CASE WHEN profile_id IS NULL AND torque_mode NOT IN ('none', 'no_torque') THEN 'unresolved mapping' END,
  CASE WHEN CASE WHEN profile_id % 3 = 0 THEN 'A' WHEN profile_id IS NOT NULL THEN 'B' END <> CASE WHEN substr(spec_sheet, 10)::INT % 2 = 0 THEN 'A' ELSE 'B' END THEN 'governing revision differs' END) AS why FROM resolved)
SELECT * FROM q WHERE why <> ''
""")
def q_review_conditions(spark, d):
    """Documents to look at, with the conditions that put them there."""
    queue = torque.review_queue(torque.resolve(*_dated_tables(spark, d)))
    return queue.select("spec_sheet", "profile_id", F.array_join("why", "; ").alias("why"))


@query(f"""
WITH {_TORQUE_SQL}, r AS (SELECT *, CASE WHEN substr(spec_sheet, 10)::INT = 1 THEN 'base' ELSE lpad((substr(spec_sheet, 10)::INT - 1)::VARCHAR, 2, '0') END AS sheet FROM resolved),
legacy AS (SELECT DISTINCT CASE WHEN o_custkey % 80 = 1 THEN 'base' ELSE lpad((o_custkey % 80 - 1)::VARCHAR, 2, '0') END AS sheet FROM orders),
e AS (SELECT r.sheet, f.fact_key FROM r JOIN profiles p ON p.profile_id = r.profile_id AND p.is_active JOIN facts f ON f.profile_id = r.profile_id),
s AS (SELECT sheet, list_sort(list_distinct(list(fact_key))) AS facts, count(*) AS n FROM e GROUP BY sheet),
g AS (SELECT sheet, bool_and(coalesce(values_verified, FALSE)) AS verified, bool_and(coalesce(profile_status = 'provisional', FALSE)) AS provisional, sum(fact_count) AS want FROM r GROUP BY sheet),
main AS (SELECT (SELECT facts FROM s WHERE sheet = '05') AS main),
c AS (
  SELECT 'old values are all resolved' AS name, (SELECT count(*) = 0 FROM legacy WHERE sheet NOT IN (SELECT sheet FROM r)) AS ok
  UNION ALL SELECT 'fact counts are those of the effective facts', (SELECT count(*) = 0 FROM g LEFT JOIN s USING (sheet) WHERE coalesce(n, 0) <> want)
  UNION ALL SELECT 'inheriting sheets have the six verified facts of /05', (SELECT count(*) = 7 FROM g JOIN s USING (sheet), main WHERE sheet IN ('01', '02', '03', '04', '06', '07', '09') AND verified AND len(facts) = 6 AND facts = main)
  UNION ALL SELECT 'board sheets share two provisional facts', (SELECT count(*) = 24 AND count(DISTINCT facts) = 1 FROM g JOIN s USING (sheet) WHERE sheet BETWEEN '10' AND '33' AND len(sheet) = 2 AND provisional AND len(facts) = 2)
  UNION ALL SELECT '/08 is isolated', (SELECT count(DISTINCT sheet) = 1 FROM r WHERE profile_id IN (SELECT profile_id FROM r WHERE sheet = '08'))
  UNION ALL SELECT '/08 needs review', coalesce((SELECT bool_and(needs_review) FROM r WHERE sheet = '08'), FALSE)
  UNION ALL SELECT 'base has no effective facts', (SELECT count(*) = 0 FROM e WHERE sheet = 'base'))
SELECT name, CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status FROM c
""")
def q_parity(spark, d):
    """The seven checks before serving changes over; suppliers stand for sheets, the first for the base document."""
    status, mapping, profiles, facts, evidence = _torque_tables(spark, d)
    n = F.regexp_extract("spec_sheet", "([0-9]+)$", 1).cast("int") - 1
    sheet = F.when(n == 0, "base").otherwise(F.lpad(n.cast("string"), 2, "0"))
    resolved = torque.resolve(status, mapping, profiles, facts, evidence).withColumn("slash_sheet", sheet).drop("is_active")
    found = torque.effective_by_sheet(resolved, profiles, facts, quality.PARITY_FACTS)
    return quality.parity_by_sheet(evidence.select(sheet.alias("slash_sheet")).distinct(), resolved, found).select("name", "status")


@query(f"""
WITH {PARTS_SQL}, w AS (SELECT l_partkey::VARCHAR AS config_id, string_agg(l_linenumber || '/' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS wires FROM lineitem GROUP BY 1),
e AS (SELECT 'Brand#' || n_nationkey AS spec_sheet, string_agg(n_name, ',' ORDER BY n_name) AS torque FROM nation WHERE n_nationkey % 2 = 0 GROUP BY 1)
SELECT p.config_id, w.wires, coalesce(e.torque, (SELECT string_agg(s_name, ',' ORDER BY s_name) FROM supplier WHERE lpad(s_nationkey::VARCHAR, 2, '0') = p.slash_sheet OR (p.hardware_ref IS NOT NULL AND s_nationkey = 5)), '') AS torque, p.finish_code AS hardware
FROM parts p LEFT JOIN w ON w.config_id = p.config_id LEFT JOIN e ON e.spec_sheet = p.spec_sheet WHERE p.config_id IN ('7', '8', '9', '10')
""")
def g_part_detail(spark, d):
    """Four parts by id, each with wires, torque and hardware options; an id that isn't there gives no row."""
    c = configurations(spark, d).withColumn("attributes", F.concat(F.lit('{"hardware_options":[{"code":"'), "finish_code", F.lit('"},{"x":1}]}')))
    wires = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("config_id"), F.col("l_linenumber").alias("wire_code"), F.col("l_returnflag").alias("wire_spec"))
    effective = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("spec_sheet"), F.col("n_name").alias("torque_text"))
    raw = table(spark, d, "supplier").select(F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("slash_sheet"), F.col("s_name").alias("torque_text"))
    parts = [search.part_detail(c, wires, effective, raw, one) for one in ("7", "8", "9", "10", "unknown")]
    shown = F.array_join(F.transform("wires", lambda w: F.concat(w["wire_code"].cast("string"), F.lit("/"), w["wire_spec"])), ",")
    return reduce(DataFrame.unionByName, parts).select(
        "config_id", shown.alias("wires"), F.array_join("torque", ",").alias("torque"), F.array_join(F.transform("hardware_options", lambda o: o["code"]), ",").alias("hardware")
    )


@query(f"""
WITH {_TORQUE_SQL}, {PARTS_SQL}, k AS (SELECT *, config_id::BIGINT % 2 = 0 AS live, config_id::BIGINT % 100 + 1 AS document_id FROM parts WHERE config_id::BIGINT % 4 <> 3),
li AS (SELECT l_partkey::VARCHAR AS config_id FROM lineitem), docs AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_name NOT LIKE '%0')
SELECT 'documents' AS view_name, count(*) AS n_rows FROM docs
UNION ALL SELECT 'configurations', count(*) FROM k
UNION ALL SELECT s || '_configurations', count(config_id) FROM (VALUES ('01'), ('02'), ('03'), ('04'), ('base')) t(s) LEFT JOIN k ON slash_sheet = s GROUP BY s
UNION ALL SELECT 'extraction_runs', count(*) FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT '03_wire_options', count(*) FROM k JOIN li USING (config_id) WHERE slash_sheet = '03'
UNION ALL SELECT 'torque_values', count(*) FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'torque_document_summary', count(*) FROM status WHERE spec_sheet NOT LIKE '%0'
UNION ALL SELECT 'torque_profile_values', count(*) FROM profiles JOIN facts USING (profile_id) WHERE kind = 'canonical'
UNION ALL SELECT 'torque_resolution', count(*) FROM resolved WHERE spec_sheet NOT LIKE '%0'
UNION ALL SELECT 'torque_effective_facts', count(*) FROM resolved r JOIN profiles p ON p.profile_id = r.profile_id AND p.is_active JOIN facts f ON f.profile_id = r.profile_id WHERE r.spec_sheet NOT LIKE '%0'
UNION ALL SELECT 'configurations_current', count(*) FROM k WHERE live
UNION ALL SELECT 'wire_options_current', count(*) FROM k JOIN li USING (config_id) WHERE live
UNION ALL SELECT 'torque_effective_current', count(*) FROM docs JOIN profiles p ON p.profile_id = s_nationkey JOIN facts f ON f.profile_id = p.profile_id WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'documents_current', count(*) FROM docs WHERE s_suppkey IN (SELECT document_id FROM k WHERE live)
""")
def g_views(spark, d):
    """Rows of all 18 serving views by name, over two families and two releases."""
    other = lambda c: F.when(c, "other").otherwise("83513").alias("spec_family")
    k, s = F.col("config_id").cast("long"), F.col("spec_sheet").endswith("0")
    status, mapping, profiles, facts, evidence = _torque_tables(spark, d)
    tables = {
        "documents": table(spark, d, "supplier").select(F.col("s_suppkey").alias("document_id"), F.col("s_name").alias("spec_sheet"), F.col("s_nationkey").cast("string").alias("slash_sheet")).select("*", other(s)),
        "configurations": configurations(spark, d).select("*", other(k % 4 == 3), F.when(k % 2 == 0, "r1").otherwise("r2").alias("release_id"), (k % 100 + 1).alias("document_id")),
        "extraction_runs": table(spark, d, "orders").select("o_orderkey", other(F.col("o_orderkey") % 3 == 0)),
        "wire_options": table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("config_id"), "l_linenumber"),
        "torque_values": table(spark, d, "customer").select("c_custkey", other(F.col("c_custkey") % 5 == 0)),
        "torque_status": status.select("*", other(s)), "torque_map": mapping, "torque_facts": facts, "torque_evidence": evidence,
        "torque_profiles": profiles.withColumn("profile_code", F.when(F.col("kind") == "canonical", F.concat(F.lit("m83513_"), "profile_id")).otherwise("x")),
        "profile_links": table(spark, d, "supplier").select(F.col("s_suppkey").alias("document_id"), F.col("s_nationkey").alias("profile_id"), F.when(F.col("s_suppkey") % 3 == 0, "r1").otherwise("r2").alias("release_id")),
    }
    pointer = spark.createDataFrame([("83513", "r1")], "spec_family string, release_id string")
    return table_counts(views.family_views(tables) | views.current_views(tables, pointer)).withColumnRenamed("table_name", "view_name")


@query("""
WITH pointer AS (SELECT 1 AS n_regionkey)
SELECT r_name, n_name, s_suppkey, c.n_customers FROM pointer JOIN region ON r_regionkey = pointer.n_regionkey JOIN nation ON nation.n_regionkey = r_regionkey
JOIN supplier ON s_nationkey = n_nationkey JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey) c ON c_nationkey = n_nationkey
""")
def j_current_release(spark, d):
    """Rows of the active release: a pointer of one row joined to region, nation, supplier and a count of customers."""
    pointer = spark.createDataFrame([(1,)], "r_regionkey int")
    regions = release.current(table(spark, d, "region"), pointer, ("r_regionkey",))
    n = table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_customers"))
    j = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(c, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("r_name", "n_name", "s_suppkey", "n_customers")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)")
def j_semi_docs(spark, d):
    li = table(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(li, "o_orderkey", "left_semi")


@query("SELECT c_custkey, n_name, s_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN supplier ON s_suppkey = substr(c_name, 10)::INT % 200")
def j_lookup_left(spark, d):
    c = table(spark, d, "customer").withColumn("k", F.regexp_extract("c_name", "([0-9]+)$", 1).cast("int") % 200)
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    return c.join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(s, F.col("s_suppkey") == F.col("k"), "left").select("c_custkey", "n_name", "s_name")


def _records(spark):
    """One record for each sheet with expected inserts."""
    rows = []
    for key, inserts in dims.INSERTS.items():
        cavities = dims.CAVITIES + [100, 100]
        listed = [(c, cavities[i]) for i, c in enumerate(inserts)]
        finishes = [(c, dict(dims.FINISHES)[c]) for c in dims.EXPECTED_FINISHES[key]]
        parts = ["insert_arrangement"] + ["wire_type_code"] * (key in "3489") + ["shell_finish_code"] * (key in "1234")
        rows.append((key, "plug_receptacle", f"MIL-DTL-83513/{key}H", "title", "H", None, 1.0, f"M83513/0{key}", parts, listed, finishes, "Plug" if key in "1368" else "Receptacle", "Pin", "Solder", "M" if key in "1234" else "P", "Metal", "Standard polarized shell", 3.0, [], None, [], [], [], "{}"))
    return spark.createDataFrame(rows, variants.RECORD)


def _no_shapes(spark):
    return spark.createDataFrame([], "doc_key string, page_number int, cavity_count int, shell_letter string, dimensions map<string,double>, ordinal int")


_MATES_SQL = f"""
{PARTS_SQL}, links AS (SELECT DISTINCT s.*, lpad(u.n::VARCHAR, 2, '0') AS mate_sheet FROM parts s, unnest(s.mate_numbers) u(n)),
pairs AS (
  SELECT s.config_id AS source_config_id, c.config_id, c.slash_sheet, c.cavity_count, c.shell_letter, c.spec_sheet, coalesce(c.revision, '') AS rev, c.source_page <> 0 AS has_page,
    (upper(s.gender) <> upper(c.gender))::INT + (upper(s.contact_type) <> upper(c.contact_type))::INT AS pairing, s.shell_letter IS NOT DISTINCT FROM c.shell_letter AS shell_match,
    upper(s.gender) <> upper(c.gender) AS og, upper(s.contact_type) <> upper(c.contact_type) AS oc
  FROM links s JOIN parts c ON c.slash_sheet = s.mate_sheet AND c.cavity_count = s.cavity_count AND (s.shell_letter IS NULL OR s.shell_letter = c.shell_letter)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_config_id ORDER BY pairing DESC, shell_match DESC, has_page DESC, rev <> '' DESC, rev DESC, spec_sheet DESC, config_id) AS place FROM pairs
)
"""


@query(f"WITH {_MATES_SQL} SELECT source_config_id, config_id, pairing, shell_match, place::INT AS place FROM ranked")
def j_mates(spark, d):
    c = configurations(spark, d)
    return search.mates_of_all(c, c).select("source_config_id", "config_id", "pairing", "shell_match", "place")


@query(f"""
WITH {_MATES_SQL}, owners AS (SELECT min(config_id) AS source_config_id FROM parts GROUP BY mate_numbers, cavity_count, shell_letter, gender, contact_type, hardware_ref)
SELECT source_config_id, config_id, place::INT AS place FROM ranked SEMI JOIN owners USING (source_config_id)
""")
def j_mate_profiles(spark, d):
    """Ranked mates of each profile, under the smallest part that has it: a row a pair of profiles' mates, not of parts."""
    c = configurations(spark, d)
    ranked, members = search.mates_by_profile(c, c)
    least = members.groupBy("source_profile").agg(F.min("source_config_id").alias("source_config_id"))
    return ranked.join(least, "source_profile").select("source_config_id", "config_id", "place")


@query(f"""
WITH {_MATES_SQL} SELECT source_config_id, config_id, 'Listed as a mating sheet; Same cavity count' || CASE WHEN shell_match THEN '; Same shell size' ELSE '' END || CASE WHEN og THEN '; Opposite gender' ELSE '' END
  || CASE WHEN oc THEN '; Opposite contact type' ELSE '' END || CASE WHEN rev <> '' THEN '; Active revision' ELSE '' END AS reasons FROM ranked
""")
def f_reasons(spark, d):
    """Reasons of every part and mate: made once for each two kinds of parts, then spelled out for their ids."""
    c = configurations(spark, d)
    return search.mate_reasons(c, c)


@query(f"""
WITH {_MATES_SQL} SELECT source_config_id, concat_ws(':', slash_sheet, cavity_count, coalesce(shell_letter, '')) AS family_key, arg_min(config_id, place) AS best, count(*) AS n_variants,
  max(pairing) AS pairing, string_agg(config_id, ',' ORDER BY place) AS variants FROM ranked GROUP BY ALL
""")
def a_mate_family(spark, d):
    """Mates of every part by family, best first: the flagship query."""
    c = configurations(spark, d)
    f = search.mate_families(c, c)
    return f.select("source_config_id", "family_key", "best", "n_variants", "pairing", F.array_join("variants", ",").alias("variants"))


@query("""
WITH rules(lo, hi, profile_code, torque_mode) AS (VALUES (5,5,'m83513_05_main','owns_profile'),(1,4,'m83513_05_main','references_other_doc'),(6,7,'m83513_05_main','references_other_doc'),
  (9,9,'m83513_05_main','references_other_doc'),(10,33,'m83513_pcb_shared','uses_shared_profile'),(8,8,'m83513_08_provisional','needs_review')),
e AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY l_suppkey)
SELECT s_suppkey, profile_code, coalesce(torque_mode, CASE WHEN n IS NULL THEN 'none' ELSE 'needs_review' END) AS torque_mode, coalesce(n, 0) AS extracted_row_count
FROM supplier LEFT JOIN rules ON s_suppkey BETWEEN lo AND hi LEFT JOIN e ON l_suppkey = s_suppkey
""")
def j_rule_range(spark, d):
    docs = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("spec_sheet"), F.col("s_suppkey").cast("string").alias("slash_sheet"))
    rows = table(spark, d, "lineitem").where("l_suppkey % 2 = 0").select(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("spec_sheet"), F.col("l_shipdate").alias("extracted_at"))
    return torque.classify(docs, rows, dims.profile_rules(spark)).select("s_suppkey", "profile_code", "torque_mode", "extracted_row_count")


@query("""
WITH notes(k, v) AS (VALUES ('red','n1'),('small','n2'),('ring','n3'),('bolt','n4')), w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS k FROM part)
SELECT p_partkey, string_agg(v, ' | ' ORDER BY v) AS notes FROM w JOIN notes USING (k) GROUP BY p_partkey
""")
def j_note_refs(spark, d):
    notes = F.create_map(*[F.lit(x) for p in (("red", "n1"), ("small", "n2"), ("ring", "n3"), ("bolt", "n4")) for x in p])
    found = F.array_sort(F.array_compact(F.transform(F.split("p_name", " "), lambda k: F.try_element_at(notes, k))))
    return table(spark, d, "part").select("p_partkey", F.array_join(found, " | ").alias("notes")).where("notes != ''")


@query("""
SELECT a.doc_id, sha256(a.text) AS checksum, sha256(b.text) AS old_checksum FROM documents a LEFT JOIN (SELECT doc_id - 1 AS doc_id, text FROM documents WHERE doc_id % 3 = 0) b ON a.doc_id = b.doc_id
WHERE sha256(a.text) IS DISTINCT FROM sha256(b.text)
""")
def j_hash_mismatch(spark, d):
    docs = table(spark, d, "documents")
    stored = docs.where("doc_id % 3 = 0").select((F.col("doc_id") - 1).alias("doc_id"), F.sha2("text", 256).alias("checksum"))
    return changed(stored, docs.select("doc_id", F.sha2("text", 256).alias("checksum")), "doc_id", "checksum")


@query("""
WITH a AS (SELECT p_brand, count(*) AS n FROM part WHERE p_size > 20 GROUP BY 1), b AS (SELECT p_brand, count(*) AS n FROM part WHERE p_size < 30 AND p_brand <> 'Brand#3' GROUP BY 1)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(a.n, 0) AS live, coalesce(b.n, 0) AS staged, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b ON a.p_brand = b.p_brand WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
""")
def j_full_diff(spark, d):
    p = table(spark, d, "part")
    return count_diff(p.where("p_size > 20"), p.where("p_size < 30 and p_brand != 'Brand#3'"), ["p_brand"])


@query("""
WITH s AS (SELECT l_suppkey, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY 1), f AS (SELECT l_suppkey, unnest(range(lo, hi + 1)) AS l_partkey FROM s)
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = f.l_suppkey AND l.l_partkey = f.l_partkey)
""")
def j_anti_gaps(spark, d):
    """All gaps of every supplier."""
    return gaps(table(spark, d, "lineitem"), "l_suppkey", "l_partkey")


@query("WITH t(token) AS (VALUES ('hand'), ('ring'), ('tion'), ('zz')) SELECT item_id, token FROM benchmark, t WHERE contains(text, token)")
def j_theta_contains(spark, d):
    """Which of a few fixed tokens stand in a text: a filter of a literal array, no join."""
    tokens = F.array(*[F.lit(x) for x in ("hand", "ring", "tion", "zz")])
    return table(spark, d, "benchmark").select("item_id", F.explode(F.filter(tokens, lambda x: F.col("text").contains(x))).alias("token"))


@query("""
SELECT count(*) = 0 AS is_subset, count(*) AS n_missing FROM (SELECT p_brand, p_type FROM part WHERE p_size < 5 EXCEPT SELECT p_brand, p_type FROM part WHERE p_size >= 5)
""")
def j_subset(spark, d):
    p = table(spark, d, "part")
    return is_subset(p.where("p_size < 5"), p.where("p_size >= 5"), ["p_brand", "p_type"])


@query("SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_quantity < 2 EXCEPT SELECT p_partkey FROM part WHERE p_size < 25")
def u_only_left(spark, d):
    li = table(spark, d, "lineitem").where("l_quantity < 2").select(F.col("l_partkey").alias("p_partkey"))
    return only_left(li, table(spark, d, "part").where("p_size < 25"), ["p_partkey"])
