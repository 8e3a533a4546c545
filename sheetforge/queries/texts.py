"""Text, identifiers, dates and extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import values as v
from ..operators import extract
from ..sources import web
from ..sources.tables import table
from .base import PARTS_SQL, configurations, query


@query(r"""
WITH c AS (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, i::INT AS chunk_index, sha256(substr(t, (i - 1) * 1800 + 1, 1800)) AS chunk_sha FROM c, range(1, len(t) // 1800 + 2) r(i) WHERE (i - 1) * 1800 < len(t)
""")
def f_collapse_chunk(spark, d):
    one = table(spark, d, "documents").select("doc_id", F.explode(t.chunks("text")).alias("c"))
    return one.select("doc_id", "c.chunk_index", F.sha2("c.chunk_text", 256).alias("chunk_sha"))


@query(r"""
SELECT page_id, sha256(trim(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'))) AS text_sha,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages
""")
def f_strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2(t.strip_tags("html"), 256).alias("text_sha"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query(r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS a FROM pages)
SELECT page_id, (i - 1)::INT AS place, a[i] AS href FROM (SELECT page_id, a, unnest(generate_series(1, len(a))) AS i FROM l)
""")
def f_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(web.links("html")).alias("place", "l")).select("page_id", "place", "l.href")


@query(f"""
WITH {PARTS_SQL}
SELECT config_id, upper(gender) || '_' || upper(contact_type) || '_SOLDER' AS code, 'Micro-D ' || gender || ' ' || cavity_count || '-Pin Class M Solder (' || contact_type || ')' AS display_name,
  'MICRO-D, ' || upper(gender) || ', ' || cavity_count || ' PIN, CLASS M, SOLDER, ' || upper(spec_sheet) || ', ' || upper(contact_type) AS full_description,
  'M83513/' || slash_sheet || '-A' || finish_code AS pin, 'MIL-DTL-83513/' || ltrim(slash_sheet, '0') || coalesce(revision, '') AS spec, 'archive/' || slash_sheet || '/x.' || substr(sha256(name), 1, 12) || '.pdf' AS archived
FROM parts
""")
def f_names(spark, d):
    m, solder = F.lit("M"), F.lit("Solder")
    return configurations(spark, d).select(
        "config_id", t.connector_code("gender", "contact_type", solder).alias("code"), t.connector_name("gender", "contact_type", solder, m, "cavity_count").alias("display_name"),
        t.connector_description("gender", "contact_type", solder, m, F.lit(None).cast("string"), "cavity_count", "spec_sheet").alias("full_description"),
        t.part_number(F.concat(F.lit("M83513/"), "slash_sheet"), F.lit("A"), F.array(F.lit("insert_arrangement"), F.lit("shell_finish_code")), "finish_code").alias("pin"),
        t.spec_sheet(F.lit("83513"), "slash_sheet", "revision").alias("spec"), t.archive_path(F.concat("slash_sheet", F.lit("/x.pdf")), F.sha2("name", 256)).alias("archived"),
    )


@query(r"""
WITH r AS (SELECT c_custkey, 'MIL-DTL-83513/' || (c_custkey % 40) || 'H(' || (c_custkey % 7) || ')' AS ref FROM customer)
SELECT c_custkey, '83513' AS family, lpad((c_custkey % 40)::VARCHAR, 2, '0') AS sheet, (c_custkey % 7)::VARCHAR AS amendment, 'H' AS revision, 'MIL-DTL-83513/' || (c_custkey % 40) || 'H' AS header, (c_custkey % 7)::INT AS trailing FROM r
""")
def f_refs(spark, d):
    k = F.col("c_custkey")
    ref = F.concat(F.lit("MIL-DTL-83513/"), (k % 40).cast("string"), F.lit("H("), (k % 7).cast("string"), F.lit(")"))
    return table(spark, d, "customer").withColumn("ref", ref).select(
        "c_custkey", t.related_family("ref").alias("family"), t.related_sheet("ref").alias("sheet"), t.amendment("ref").alias("amendment"), t.revision_letter("ref").alias("revision"),
        t.spec_header(F.concat(F.lit("see "), F.lower("ref"))).alias("header"), t.trailing_index(F.concat(F.lit("page-1-chunk-"), (k % 7).cast("string"))).alias("trailing"),
    )


@query(r"SELECT p_partkey, trim(regexp_replace(lower(p_name || '_' || p_brand || '_' || p_size), '[^a-z0-9]+', '_', 'g'), '_') AS fact_key, 'M83513/03-A01' || substr(p_type, 1, 1) AS pin, 'a note' AS note FROM part")
def f_fact_key(spark, d):
    raw = F.concat(F.lit(" m83513/03 – a 01 1/"), F.substr("p_type", F.lit(1), F.lit(1)))
    return table(spark, d, "part").select(
        "p_partkey", t.fact_key(F.col("p_name"), F.col("p_brand"), F.col("p_size").cast("string")).alias("fact_key"), t.clean_part_number(raw).alias("pin"), t.trim_bleed(F.lit("a  note ; supersedes page 3")).alias("note")
    )


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 10 AS lo, l_discount * 10 + l_tax * 5 AS hi FROM lineitem),
f AS (SELECT *, CASE WHEN contains(lo::DECIMAL(12,2)::VARCHAR, '.') THEN rtrim(rtrim(lo::DECIMAL(12,2)::VARCHAR, '0'), '.') END AS a, rtrim(rtrim(hi::DECIMAL(12,2)::VARCHAR, '0'), '.') AS b FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN lo <> hi THEN a || '-' || b ELSE a END || ' in-lbf #2-56 (Metal shell) governing X inherited' || CASE WHEN l_partkey % 3 = 0 THEN ' needs review' WHEN l_partkey % 2 = 0 THEN ' verified' ELSE '' END AS effective FROM f
""")
def f_display(spark, d):
    li = table(spark, d, "lineitem").withColumn("lo", F.col("l_discount") * 10).withColumn("hi", F.col("l_discount") * 10 + F.col("l_tax") * 5)
    k = F.col("l_partkey")
    text = v.effective_torque_text("lo", "hi", F.lit("#2-56"), F.lit("Metal shell"), F.lit("X"), F.lit(True), k % 3 == 0, k % 2 == 0)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("effective"))


@query(f"""
WITH {PARTS_SQL}
SELECT config_id, CASE WHEN hardware_ref IS NULL THEN 'Only one part references hardware: MIL-DTL-83513/6' ELSE 'Hardware differs: ' || hardware_ref || ' / MIL-DTL-83513/6' END AS hardware,
  spec_sheet || ', page ' || source_page AS citation, concat_ws(':', slash_sheet, connector_type, cavity_count, coalesce(shell_letter, ''), name) AS group_key FROM parts
""")
def f_citation(spark, d):
    return configurations(spark, d).select(
        "config_id", v.hardware_text("hardware_ref", F.lit("MIL-DTL-83513/6")).alias("hardware"), v.citation("spec_sheet", F.lit("doc"), "source_page").alias("citation"),
        v.group_key("slash_sheet", "connector_type", "cavity_count", "shell_letter", "name").alias("group_key"),
    )


@query(r"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\f\v]+', ' ', 'g'))),
  lambda x: len(x) BETWEEN 3 AND 100 AND ((upper(x) = x AND regexp_matches(x, '\pL')) OR regexp_matches(upper(x), 'HOW TO ORDER|DIMENSIONS|FIGURE|REQUIREMENTS|NOTES'))) AS h, text FROM documents)
SELECT doc_id, len(list_distinct(list_transform(h[1:20], lambda x: upper(x)))) AS n_headers,
  CASE WHEN contains(lower(text), 'mating connector hardware') THEN 'mating_connector_hardware' WHEN contains(lower(text), 'mounting hardware') THEN 'mounting_hardware' WHEN contains(lower(text), 'mating hardware') THEN 'mating_hardware' ELSE 'hardware' END AS context,
  substr(trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')), 1, 420) AS snippet FROM l
""")
def f_headers(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(t.headers("text")).cast("long").alias("n_headers"), t.torque_context("text").alias("context"), t.snippet("text").alias("snippet"))


@query("SELECT p_partkey, '83513-torque-' || substr(sha1(concat_ws('|', p_brand, p_type, CASE WHEN p_size % 10 = 0 THEN '' ELSE p_size::VARCHAR END)), 1, 20) AS torque_key FROM part")
def h_sha_keys(spark, d):
    n = v.falsy_to_blank(F.when(F.col("p_size") % 10 != 0, F.col("p_size")))
    return table(spark, d, "part").select("p_partkey", v.sha1_key("83513-torque-", 20, F.col("p_brand"), F.col("p_type"), n).alias("torque_key"))


@query("""
WITH h AS (SELECT n_nationkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('spec-catalog|document|' || n_name)) AS h FROM nation)
SELECT n_nationkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h
""")
def h_uuid5(spark, d):
    return table(spark, d, "nation").select("n_nationkey", v.stable_id("document", F.col("n_name")).alias("id"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS run_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, o_orderdate::DATE::VARCHAR AS parsed FROM orders")
def d_dates(spark, d):
    o = table(spark, d, "orders").withColumn("shown", F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")))
    return o.select("o_orderkey", v.run_stamp("o_orderdate").alias("run_id"), v.iso_stamp("o_orderdate").alias("stamp"), v.month_date("shown").cast("string").alias("parsed"))


# --- extraction


@query(f"""
WITH {PARTS_SQL}, u AS (SELECT config_id, upper('Connectors, ' || gender || ', ' || contact_type || ' contacts, class ' || CASE WHEN cavity_count % 2 = 0 THEN 'M' ELSE 'P' END || ', ' || CASE WHEN cavity_count % 3 = 0 THEN 'right angle straight' ELSE 'straight' END || ', ' || cavity_count % 5 || ' row') AS title, gender, contact_type, cavity_count FROM parts)
SELECT config_id, gender, contact_type, CASE WHEN cavity_count % 2 = 0 THEN 'Metal' ELSE 'Plastic' END AS shell_material, CASE WHEN cavity_count % 3 = 0 THEN 'Right Angle' ELSE 'Straight' END AS board_mount_style,
  CASE WHEN cavity_count % 5 BETWEEN 2 AND 4 THEN cavity_count % 5 END::INT AS row_count, 3.0::DOUBLE AS current_rating, 'A/B,C' AS scopes FROM u
""")
def x_attributes(spark, d):
    n = F.col("cavity_count")
    title = F.concat(F.lit("Connectors, "), "gender", F.lit(", "), "contact_type", F.lit(" contacts, class "), F.when(n % 2 == 0, "M").otherwise("P"), F.lit(", "), F.when(n % 3 == 0, "right angle straight").otherwise("straight"), F.lit(", "), (n % 5).cast("string"), F.lit(" row"))
    body = F.lit("Current rating, maximum: 3 amperes per contact. MIL-DTL-83513/5 for arrangements A through G and the 100 cavity size.")
    a = extract.attributes(title, body)
    return configurations(spark, d).select("config_id", *[a[k].alias(k) for k in ("gender", "contact_type", "shell_material", "board_mount_style", "row_count", "current_rating")], F.array_join(extract.hardware_scopes(body), ",").alias("scopes"))


@query("""
WITH w AS (SELECT item_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM benchmark)
SELECT item_id::VARCHAR AS doc_key, 1 AS page_number, ((i - 1) // 5)::INT AS line_no, string_agg(word, ' ' ORDER BY i) AS line FROM w GROUP BY ALL
""")
def x_word_lines(spark, d):
    """Benchmark words placed on a page, read back as lines."""
    w = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("doc_key"), F.lit(1).alias("page_number"), F.posexplode(F.split("text", " ")).alias("i", "word"))
    placed = w.select("doc_key", "page_number", "word", (F.floor(F.col("i") / 5) * 12.0).cast("double").alias("top"), ((F.col("i") % 5) * 40.0).alias("x0"))
    return extract.word_lines(placed)
