"""Aggregates, dedupe, windows, unions, versions and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v
from ..operators import dims, quality, search, torque
from ..operators import relational as r
from ..operators import variants
from ..plans import release
from ..sources.tables import table
from .base import PARTS_SQL, configurations, query
from .joins import _no_shapes, _records


@query("SELECT p_brand, p_type, count(*) AS n, grouping(p_brand, p_type)::BIGINT AS level FROM part GROUP BY GROUPING SETS ((), (p_brand), (p_brand, p_type))")
def a_count_1_2_keys(spark, d):
    return r.counts_by(table(spark, d, "part"), "p_brand", "p_type")


@query("SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def a_having_dup(spark, d):
    return r.repeated(table(spark, d, "part"), ["p_brand", "p_size"])


@query(f"""
WITH {PARTS_SQL}, w AS (SELECT lpad(substr(p_brand, 7), 2, '0') AS slash_sheet, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT slash_sheet, count(*) AS base_rows, count(*) FILTER (example_pin = '') AS without_example, string_agg(DISTINCT connector_type, ',' ORDER BY connector_type) AS inserts,
  string_agg(DISTINCT finish_code, ',' ORDER BY finish_code) AS finishes, coalesce(any_value(n), 0) AS wire_rows
FROM parts LEFT JOIN w USING (slash_sheet) GROUP BY slash_sheet
""")
def a_multi_measure(spark, d):
    """Measures of every sheet, with every line item as a wire."""
    c = configurations(spark, d).withColumn("insert_code", F.col("connector_type"))
    li = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("config_id"))
    wires = li.join(c.select("config_id", "slash_sheet"), "config_id")
    return quality.summary_by_sheet(c, wires).select("slash_sheet", "base_rows", "without_example", "inserts", "finishes", "wire_rows")


@query(f"""
WITH {PARTS_SQL}, h AS (
  SELECT unnest(['shell_letter', 'revision', 'hardware_ref', 'source_page', 'name']) AS field,
    unnest([count(*) FILTER (shell_letter IS NULL), count(*) FILTER (revision IS NULL), count(*) FILTER (hardware_ref IS NULL), count(*) FILTER (source_page = 0), count(*) FILTER (name IS NULL)]) AS n_missing FROM parts)
SELECT * FROM h WHERE n_missing > 0
""")
def a_missing_hist(spark, d):
    gone = {c: F.col(c).isNull() for c in ("shell_letter", "revision", "hardware_ref", "name")} | {"source_page": F.col("source_page") == 0}
    return r.missing_histogram(configurations(spark, d), gone)


@query("SELECT user_id, max(ts) AS last_ts, count(*) FILTER (event_type = 'error') AS failures, count(*) FILTER (event_type <> 'error') AS successes FROM events GROUP BY user_id")
def a_max_default(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.count_if(F.col("event_type") == "error").alias("failures"), F.count_if(F.col("event_type") != "error").alias("successes"))


@query("""
WITH g AS (SELECT l_partkey, l_quantity::INT AS g FROM lineitem WHERE l_quantity::INT IN (20,21,22,23,24,25,26,27,28,30))
SELECT l_partkey, CASE WHEN min(g) = max(g) THEN min(g) || ' AWG' ELSE min(g) || '-' || max(g) || ' AWG' END AS wire_range FROM g GROUP BY l_partkey
""")
def a_wire_range(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", F.concat(F.lit("M22759/11-"), F.col("l_quantity").cast("int"), F.lit("-9")).alias("spec"))
    return search.wire_range(li, "l_partkey", "spec")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_quantity DESC) AS n FROM lineitem) WHERE n = 1")
def a_last_wins(spark, d):
    return r.last_wins(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", "l_shipdate", "l_partkey", "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query(f"""
WITH {PARTS_SQL}
SELECT f.slash_sheet, f.config_id AS first_id, t.config_id AS titled_id FROM
  (SELECT slash_sheet, config_id FROM (SELECT *, row_number() OVER (PARTITION BY slash_sheet ORDER BY cavity_count, config_id) AS n FROM parts) WHERE n = 1) f
  JOIN (SELECT slash_sheet, config_id FROM (SELECT *, row_number() OVER (PARTITION BY slash_sheet ORDER BY coalesce(revision, '') = '', cavity_count, config_id) AS n FROM parts) WHERE n = 1) t USING (slash_sheet)
""")
def a_first_wins(spark, d):
    c = configurations(spark, d)
    first = r.first_wins(c, ["slash_sheet"], "cavity_count", "config_id").select("slash_sheet", F.col("config_id").alias("first_id"))
    titled = r.titled_first(c, ["slash_sheet"], "revision", "cavity_count", "config_id").select("slash_sheet", F.col("config_id").alias("titled_id"))
    return first.join(titled, "slash_sheet")


@query("""
WITH w AS (SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part)
SELECT p_brand, string_agg(w, ',' ORDER BY w) AS words FROM w WHERE w NOT IN ('red', 'ring') GROUP BY p_brand
""")
def a_distinct_sorted(spark, d):
    words = table(spark, d, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("w")).where(~F.col("w").isin("red", "ring"))
    return words.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("w")), ",").alias("words"))


@query(f"""
WITH {PARTS_SQL}, k AS (SELECT *, concat_ws(':', slash_sheet, connector_type, cavity_count, coalesce(shell_letter, '')) AS group_key FROM parts), n AS (
  SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY slash_sheet, cavity_count, shell_letter NULLS LAST, finish_code, config_id) AS n FROM k)
SELECT group_key, max(CASE WHEN n = 1 THEN config_id END) AS representative, count(*) AS n_variants, string_agg(DISTINCT finish_code, ',' ORDER BY finish_code) AS finishes FROM n GROUP BY group_key
""")
def a_group_rep(spark, d):
    return search.grouped(configurations(spark, d), ["slash_sheet", "connector_type", "cavity_count", "shell_letter"])


@query(f"""
WITH {PARTS_SQL}, k AS (SELECT *, concat_ws(':', slash_sheet, connector_type, cavity_count, coalesce(shell_letter, ''), name) AS group_key FROM parts WHERE name ILIKE '%bolt%' AND cavity_count = 12)
SELECT group_key, arg_min(config_id, (finish_code, config_id)) AS representative, count(*) AS n_variants, string_agg(DISTINCT finish_code, ',' ORDER BY finish_code) AS finishes, (count(*) OVER ())::BIGINT AS total FROM k GROUP BY group_key ORDER BY group_key LIMIT 25
""")
def a_search_grouped(spark, d):
    return search.search_grouped(configurations(spark, d), cavity_count=12, query="bolt")


@query("SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'pages', count(*) FROM pages")
def a_counts_union(spark, d):
    return r.table_counts({n: table(spark, d, n) for n in ("nation", "orders", "events", "pages")})


@query("SELECT n_nationkey AS profile_id, count(s_suppkey) AS fact_count FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 9000 GROUP BY 1")
def a_counts_with_zero(spark, d):
    profiles = table(spark, d, "nation").select(F.col("n_nationkey").alias("profile_id"))
    return torque.fact_counts(profiles, table(spark, d, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("profile_id")))


# --- windows


@query("SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS n FROM events) WHERE n = 1")
def w_latest(spark, d):
    return r.latest(table(spark, d, "events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "ts", "event_type")


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_purchase,
  array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), ' ') AS header FROM events
""")
def w_carry_forward(spark, d):
    e = table(spark, d, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")))
    out = r.carry_forward(e, "user_id", ["ts", "event_id"], "p", "last_purchase")
    return r.context_lines(out, "user_id", ["ts", "event_id"], "event_type", "header").select("event_id", "last_purchase", "header")


@query("""
SELECT event_id, lead(ts) OVER w AS next_ts, array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING), ' ') AS ahead FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def w_lookahead(spark, d):
    e = table(spark, d, "events").withColumn("next_ts", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    out = r.look_ahead(e, "user_id", ["ts", "event_id"], "event_type", "a")
    return out.select("event_id", "next_ts", F.when(F.size("a") > 0, F.array_join("a", " ")).alias("ahead"))


# --- unions and versions


@query("""
SELECT 'run-1' AS run_id, 'nation' AS table_name, n_regionkey::VARCHAR AS slash_sheet, '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS row_data FROM nation
UNION ALL SELECT 'run-1', 'region', r_regionkey::VARCHAR, '{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}' FROM region
""")
def u_envelope(spark, d):
    n, g = table(spark, d, "nation"), table(spark, d, "region")
    return r.envelope("run-1", {"nation": (n, F.col("n_regionkey")), "region": (g, F.col("r_regionkey"))})


_VERSIONS = """
stored AS (SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE event_id % 2 = 0) WHERE n = 1),
cand AS (SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE event_id % 2 = 1) WHERE n = 1)
"""


@query(f"""
WITH {_VERSIONS}, ok AS (SELECT c.* FROM cand c LEFT JOIN stored s USING (user_id) WHERE s.ts IS NULL OR c.ts >= s.ts)
SELECT * FROM stored WHERE user_id NOT IN (SELECT user_id FROM ok) UNION ALL SELECT * FROM ok
""")
def v_monotonic_guard(spark, d):
    """Candidates older than the stored row are rejected, the others replace it."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    stored = r.last_wins(e.where("event_id % 2 = 0"), ["user_id"], "ts", "event_id")
    cand = r.last_wins(e.where("event_id % 2 = 1"), ["user_id"], "ts", "event_id")
    ok = release.not_older(stored, cand, "user_id", "ts").withColumn("ordinal", F.col("event_id"))
    return release.merge(stored, ok, ["user_id"])


@query("""
WITH s AS (SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state, event_type AS to_state FROM events)
SELECT from_state, to_state, count(*) AS n FROM s WHERE from_state IS NOT NULL AND (from_state, to_state) NOT IN (('view', 'click'), ('click', 'purchase'), ('signup', 'view'), ('view', 'view')) GROUP BY ALL
""")
def v_state_machine(spark, d):
    valid = spark.createDataFrame([("view", "click"), ("click", "purchase"), ("signup", "view"), ("view", "view")], "from_state string, to_state string")
    return r.bad_transitions(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type", valid).groupBy("from_state", "to_state").agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, CASE WHEN toxic = 1 THEN 'reject_candidate' WHEN quality = 1 AND doc_id % 3 = 0 AND doc_id % 2 <> 0 THEN 'approve_canonical_profile' WHEN quality = 1 AND doc_id % 2 = 0 THEN 'map_existing_profile'
  WHEN quality = 1 THEN 'provisional_profile' ELSE 'evidence_only' END AS outcome FROM labels
""")
def v_promotion(spark, d):
    q, k = F.col("quality") == 1, F.col("doc_id")
    return table(spark, d, "labels").select("doc_id", torque.promotion_outcome(q, k % 2 == 0, k % 3 == 0, F.col("toxic") == 1).alias("outcome"))


# --- gates


@query("""
WITH e(p_brand, n) AS (VALUES ('Brand#1', 80), ('Brand#2', 81), ('Brand#3', 70)), a AS (SELECT p_brand, count(*) AS actual FROM part GROUP BY 1)
SELECT '/' || e.p_brand || ' has ' || n || ' rows' AS name, CASE WHEN coalesce(actual, 0) = n THEN 'pass' ELSE 'fail' END AS status, 'actual=' || coalesce(actual, 0) AS details FROM e LEFT JOIN a USING (p_brand)
UNION ALL SELECT 'no error in prices', CASE WHEN count(*) FILTER (p_retailprice <= 0) = 0 THEN 'pass' ELSE 'fail' END, count(*)::VARCHAR FROM part
""")
def q_gates(spark, d):
    p = table(spark, d, "part")
    want = spark.createDataFrame([("Brand#1", 80), ("Brand#2", 81), ("Brand#3", 70)], "p_brand string, n int")
    return quality.counts_gate(p, "p_brand", want, "/%s has %s rows").unionByName(quality.gate(p, "no error in prices", F.count_if(F.col("p_retailprice") <= 0) == 0, F.count("*")))


@query(f"""
WITH {PARTS_SQL}, cases AS (SELECT config_id AS case_id, list_sort(list_transform(mate_numbers, lambda x: lpad(x::VARCHAR, 2, '0'))) AS valid, ['05'] AS invalid FROM parts),
got AS (SELECT case_id, list_sort(list_distinct(list(p.slash_sheet))) AS got, count(*) AS n FROM cases c JOIN parts s ON s.config_id = c.case_id JOIN parts p ON p.cavity_count = s.cavity_count AND list_contains(list_transform(s.mate_numbers, lambda x: lpad(x::VARCHAR, 2, '0')), p.slash_sheet) AND (s.shell_letter IS NULL OR s.shell_letter = p.shell_letter) GROUP BY case_id)
SELECT case_id, array_to_string(list_filter(valid, lambda x: NOT list_contains(coalesce(got, []), x)), ',') AS false_negatives, CASE WHEN got IS NULL THEN 'unresolved'
  WHEN len(list_filter(valid, lambda x: NOT list_contains(got, x))) + len(list_filter(got, lambda x: list_contains(invalid, x))) > 0 THEN 'fail' WHEN n > len(got) THEN 'noisy_pass' ELSE 'pass' END AS verdict
FROM cases LEFT JOIN got USING (case_id)
""")
def q_golden(spark, d):
    """Every part as a case; parts of one profile share a verdict."""
    c = configurations(spark, d)
    keyed, each = search.profiles(c)
    cases = each.select(F.col("profile").alias("case_id"), F.array_sort(t.mate_sheets("mates_with")).alias("valid"), F.array(F.lit("05")).alias("invalid"))
    got = search.mates(each, c).select(F.col("source_profile").alias("case_id"), "slash_sheet")
    verdicts = quality.golden_verdicts(cases, got).select(F.col("case_id").alias("profile"), F.array_join("false_negatives", ",").alias("false_negatives"), "verdict")
    return keyed.select(F.col("config_id").alias("case_id"), "profile").join(verdicts, "profile").drop("profile")


@query("""
WITH v AS (SELECT 'positive balance' AS rule, s_suppkey::VARCHAR AS key FROM supplier WHERE NOT s_acctbal > 0 UNION ALL SELECT 'known nation', s_suppkey::VARCHAR FROM supplier WHERE NOT s_nationkey BETWEEN 0 AND 20) SELECT * FROM v
""")
def q_violations(spark, d):
    rules = {"positive balance": F.col("s_acctbal") > 0, "known nation": F.col("s_nationkey").between(0, 20)}
    return quality.violations(table(spark, d, "supplier"), "s_suppkey", rules)


@query("""
WITH b AS (
  SELECT d.doc_id, greatest(0.0, 1.0 - CASE WHEN quality IS NULL THEN 0.12 ELSE 0 END - CASE WHEN n_chars < 200 THEN 0.20 ELSE 0 END - CASE WHEN lang <> 'en' THEN 0.10 ELSE 0 END - CASE WHEN coalesce(toxic, 0) = 1 THEN 0.50 ELSE 0 END)::DOUBLE AS score
  FROM documents d LEFT JOIN labels USING (doc_id))
SELECT doc_id, round_even(score, 2)::DOUBLE AS confidence, score < 0.85 AS needs_fallback, (n_chars_piece)::INT AS ordinal FROM b JOIN (SELECT doc_id, n_chars // 1800 + 1 AS n_chars_piece FROM documents) USING (doc_id)
""")
def m_score(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    part = lambda c, x: F.when(c, x).otherwise(0.0)
    score = v.clamped_score(1.0, part(F.col("quality").isNull(), 0.12), part(F.col("n_chars") < 200, 0.20), part(F.col("lang") != "en", 0.10), part(F.coalesce("toxic", F.lit(0)) == 1, 0.50))
    return j.withColumn("score", score).select("doc_id", F.bround("score", 2).alias("confidence"), (F.col("score") < 0.85).alias("needs_fallback"), v.ordinal("n_chars", 1800).alias("ordinal"))


@query("""
WITH a AS (SELECT CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS verdict, p_partkey::VARCHAR AS case_id FROM part)
SELECT verdict, count(*) AS n, string_agg(case_id, ',' ORDER BY case_id) AS case_ids FROM a GROUP BY verdict
""")
def a_verdict_summary(spark, d):
    return quality.verdict_summary(table(spark, d, "part").select(F.when(F.col("p_size") > 25, "large").otherwise("small").alias("verdict"), F.col("p_partkey").cast("string").alias("case_id")))


@query("WITH a AS (SELECT CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS verdict, p_partkey::VARCHAR AS case_id FROM part) SELECT verdict, count(*) OVER (PARTITION BY verdict) AS n, case_id FROM a")
def a_verdict_cases(spark, d):
    """Every case with the number of those that have its verdict."""
    return quality.verdict_cases(table(spark, d, "part").select(F.when(F.col("p_size") > 25, "large").otherwise("small").alias("verdict"), F.col("p_partkey").cast("string").alias("case_id")))
