"""Projections, filters, paging and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import quality, search
from ..operators.relational import page, semi_by_values
from ..sources.tables import TableQuery, sheet_order, table
from .base import PARTS_SQL, configurations, query


@query("SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE p_brand = 'Brand#5'")
def p_select_view(spark, d):
    return TableQuery(table(spark, d, "part")).eq("p_brand", "Brand#5").select("p_partkey", "p_name", "p_brand", "p_type")


@query(f"""
WITH {PARTS_SQL}, f AS (
  SELECT *, count(*) OVER () AS total FROM parts
  WHERE name ILIKE '%ring%' OR description ILIKE '%ring%' OR example_pin ILIKE '%ring%' OR spec_sheet ILIKE '%ring%'
)
SELECT config_id, slash_sheet, cavity_count, shell_letter, finish_code, total FROM f
ORDER BY slash_sheet NULLS LAST, cavity_count NULLS LAST, shell_letter NULLS LAST, finish_code NULLS LAST, config_id LIMIT 25 OFFSET 5
""")
def p_search_raw(spark, d):
    return search.search_raw(configurations(spark, d), 25, 5, query="ring").select("config_id", "slash_sheet", "cavity_count", "shell_letter", "finish_code", "total")


@query("SELECT p_brand, count(*) AS n FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#20') GROUP BY p_brand")
def p_in_list(spark, d):
    return semi_by_values(table(spark, d, "part"), "p_brand", ["Brand#1", "Brand#7", "Brand#20"]).groupBy("p_brand").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey,
  (n.n_name = 'NATION_1' AND s_acctbal > 5000) AS verified,
  CASE WHEN n.n_nationkey IS NULL THEN FALSE WHEN s_acctbal < 0 THEN TRUE WHEN n.n_regionkey <> 1 THEN TRUE ELSE FALSE END AS inherited,
  CASE WHEN n.n_nationkey IS NULL AND s_suppkey % 3 NOT IN (0, 1) THEN TRUE WHEN s_acctbal IN (0, 1) THEN TRUE ELSE FALSE END AS needs_review
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n_nationkey = s_nationkey
""")
def p_bool_case(spark, d):
    """Flags over a left join in three-valued logic."""
    n = table(spark, d, "nation").where("n_regionkey < 3")
    j = table(spark, d, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    none = F.col("n_nationkey").isNull()
    return j.select(
        "s_suppkey",
        ((F.col("n_name") == "NATION_1") & (F.col("s_acctbal") > 5000)).alias("verified"),
        F.when(none, False).when(F.col("s_acctbal") < 0, True).when(F.col("n_regionkey") != 1, True).otherwise(False).alias("inherited"),
        F.when(none & ~(F.col("s_suppkey") % 3).isin(0, 1), True).when(F.col("s_acctbal").isin(0, 1), True).otherwise(False).alias("needs_review"),
    )


@query("""
SELECT p_partkey, lpad(split_part(p_brand, '#', 2), 2, '0') AS sheet, split_part(p_brand, '#', 2)::INT AS sheet_order,
  ltrim(split_part(p_brand, '#', 2), '0') AS document_filter
FROM part WHERE regexp_matches(split_part(p_brand, '#', 2), '^[0-9]+$')
""")
def p_regex_digits(spark, d):
    p = table(spark, d, "part").withColumn("n", F.split("p_brand", "#")[1]).where(F.col("n").rlike("^[0-9]+$"))
    return p.select("p_partkey", t.sheet_key("n").alias("sheet"), sheet_order("n").alias("sheet_order"), t.document_filter(F.concat(F.lit(" /0"), "n")).alias("document_filter"))


@query("""
SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN 1 END, 0) AS positive
FROM customer WHERE c_name LIKE 'Customer_0000000%' AND c_acctbal IS NOT NULL AND c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD')
""")
def p_like_prefix(spark, d):
    c = table(spark, d, "customer").where(F.col("c_name").like("Customer_0000000%") & F.col("c_acctbal").isNotNull() & ~F.coalesce("c_mktsegment", F.lit("")).isin("MACHINERY", "HOUSEHOLD"))
    return c.select("c_custkey", F.coalesce(F.when(F.col("c_acctbal") > 0, 1), F.lit(0)).alias("positive"))


@query("""
SELECT event_id, upper(event_type) AS kind, (props->>'$.k')::INT AS k FROM events
WHERE (props->>'$.k') IS NOT NULL AND event_type LIKE '%c%'
""")
def p_has_json_option(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k")).where(F.col("k").isNotNull() & F.col("event_type").contains("c"))
    return e.select("event_id", F.upper("event_type").alias("kind"), F.col("k").cast("int").alias("k"))


@query("""
WITH g AS (
  SELECT doc_id, n_chars BETWEEN 10 AND 33000 AS in_range, contains(lower(text), 'the') AND contains(lower(text), 'and') AS phrases,
    regexp_matches(text, '[0-9]*\\.[0-9]+') AS has_decimal, regexp_matches(lower(source), 'src1[0-9]') AS notice
  FROM documents
)
SELECT doc_id, in_range, phrases, has_decimal FROM g WHERE NOT notice
UNION ALL
SELECT -1, TRUE, TRUE, count(*) > 0 FROM events WHERE event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')
""")
def p_page_gate(spark, d):
    """Gates on text, and one row that says whether an enumeration is broken."""
    docs = table(spark, d, "documents").where(~F.lower("source").rlike("src1[0-9]"))
    gates = docs.select(
        "doc_id", F.col("n_chars").between(10, 33000).alias("in_range"), (F.lower("text").contains("the") & F.lower("text").contains("and")).alias("phrases"), F.col("text").rlike(r"[0-9]*\.[0-9]+").alias("has_decimal")
    )
    allowed = {"event_type": F.col("event_type").isin("click", "error", "purchase", "signup", "view")}
    broken = quality.violations(table(spark, d, "events"), "event_id", allowed).agg((F.count("*") > 0).alias("has_decimal"))
    return gates.unionByName(broken.select(F.lit(-1).cast("long").alias("doc_id"), F.lit(True).alias("in_range"), F.lit(True).alias("phrases"), "has_decimal"))


@query("""
SELECT p_partkey, p_brand, p_retailprice FROM part
ORDER BY split_part(p_brand, '#', 2)::INT, p_retailprice DESC, p_partkey LIMIT 40 OFFSET 10
""")
def o_topk_offset(spark, d):
    order = [sheet_order("split(p_brand, '#')[1]").asc(), F.col("p_retailprice").desc(), F.col("p_partkey").asc()]
    return page(table(spark, d, "part"), order, 40, 10, None).select("p_partkey", "p_brand", "p_retailprice")


@query(f"WITH {PARTS_SQL} SELECT config_id, CASE WHEN len(mate_numbers) > 0 AND NOT (mate_numbers[1] = 5 AND mate_numbers[2] = 5) THEN array_to_string(list_transform(list_filter(mate_numbers, lambda x: x <> 5), lambda x: 'MIL-DTL-83513/' || x), ', ') ELSE 'Not yet extracted' END AS shown FROM parts")
def p_shown_mates(spark, d):
    """The list that users see (mates without the hardware sheet)."""
    shown = search.shown_mates("mates_with", F.lit("MIL-DTL-83513/5"))
    return configurations(spark, d).select("config_id", shown.alias("shown"))
