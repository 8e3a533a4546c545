"""Extraction from page text that is put together from the given tables, a document a part; the SQL computes what has to be read back.

In texts and SQL: a and b are numbers of three digits, c and e cavity counts, f a finish, h a hardware code of a part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import dims, extract, quality, variants
from ..plans import extraction
from ..sources import web
from ..sources.tables import table
from .base import query
from .extracted import NO_SHAPES
from .joins import _records

_HARDWARE = [("N", "no hardware or threaded insert"), ("P", "jackpost attach"), ("T", "threaded insert"), ("W", "jackpost and threaded insert")]
_SHELL = "CASE {c} WHEN 51 THEN 'B' WHEN 100 THEN 'C' ELSE 'A' END"


def _numbers(spark, d):
    """The numbers and words of each part that its pages are made of."""
    k, size = F.col("p_partkey"), F.col("p_size")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(x) for x in values]), (at % len(values)).cast("int") + 1)
    return table(spark, d, "part").select(
        (k + 10).cast("string").alias("doc_key"), k, "p_name", size, (k % 900 + 100).cast("string").alias("a"), (size * 17 % 900 + 100).cast("string").alias("b"), (k % 33 + 1).cast("string").alias("m"),
        pick(dims.CAVITIES, k).alias("c"), pick(dims.CAVITIES, F.floor(k / 8)).alias("e"), pick([x for x, _ in dims.FINISHES], k).alias("f"), pick([x for _, x in dims.FINISHES], k).alias("finish"),
        pick([x for x, _ in _HARDWARE], k).alias("h"), pick([x for _, x in _HARDWARE], k).alias("hardware"),
    )


def _list_sql(values):
    return "[" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in values) + "]"


def _pick_sql(values, at):
    return f"{_list_sql(values)}[({at}) % {len(values)} + 1]"


NUMBERS_SQL = f"""
n AS (
  SELECT (p_partkey + 10)::VARCHAR AS doc_key, p_partkey AS k, p_name, p_size, (p_partkey % 900 + 100)::VARCHAR AS a, (p_size * 17 % 900 + 100)::VARCHAR AS b, (p_partkey % 33 + 1)::VARCHAR AS m,
    {_pick_sql(dims.CAVITIES, "p_partkey")} AS c, {_pick_sql(dims.CAVITIES, "p_partkey // 8")} AS e, {_pick_sql([x for x, _ in dims.FINISHES], "p_partkey")} AS f,
    {_pick_sql([x for _, x in dims.FINISHES], "p_partkey")} AS finish, {_pick_sql([x for x, _ in _HARDWARE], "p_partkey")} AS h, {_pick_sql([x for _, x in _HARDWARE], "p_partkey")} AS hardware
  FROM part
)
"""
#: The first page of each document, and its second, as pieces: text, or the name of a column.
_FIRST = ["MIL-DTL-83513/", "m", "H\nREQUIREMENTS\nPart or Identifying Number (PIN): M83513/", "m2", "-A N.\nA = ", "c", "  ", "f", " = ", "finish", "\nB = ", "e", "\nDimension A 0.", "a", " and B = 1.", "b",
          ", A 9.99. FIGURE ", "p_size", ". ", "p_name", ". FIGURE 777.\n. Referenced documents D = 25\n01 = .", "a", " 02 = .", "b", " ", "h", " = ", "hardware"]
_BARE = ["MIL-DTL-83513/", "m", "H\nREQUIREMENTS\nFIGURE ", "p_size", ". ", "p_name", ". FIGURE 777.\n. The end"]
_TABLE = ["NUMBER OF\nCONTACTS A B D\n", "c", " 0.", "a", " 0.", "b", " .308\n", "e", " 0.", "b", " 0.", "a", " .309"]
_TORQUE = ["Mounting hardware torque: ", "lo", ".0 to ", "hi", ".0 inch-pounds for all. Mating hardware ", "one", ".5 in-lbs for #2-56 (Metal  shell). Torque ends."]
_WIRES = ["01 = M22759/11-26-9 ", "inches", " inches long 1/ 2/ 02 = M22759/33-26-9 0.5 1/ 7/ 03 = no length 1/ These connectors are fine. 2/ Old note 2/ For space applications only by ", "p_name", " supersedes page 4"]
_NAMES = {"m", "m2", "c", "f", "finish", "e", "a", "b", "p_size", "p_name", "h", "hardware", "lo", "hi", "one", "inches"}


def _text(pieces):
    return F.concat(*[F.col(x).cast("string") if x in _NAMES else F.lit(x) for x in pieces])


def _text_sql(pieces):
    return " || ".join(f"{x}::VARCHAR" if x in _NAMES else "'" + x.replace("\n", "' || chr(10) || '") + "'" for x in pieces)


def _pages(spark, d, pieces=_FIRST, page=1):
    more = {"m2": F.lpad("m", 2, "0"), "lo": F.col("p_size") % 9 + 1, "hi": F.col("p_size") % 9 + 3, "one": F.col("p_partkey") % 7 + 1, "inches": F.col("p_size") + 10}
    return _numbers(spark, d).withColumns(more).select("doc_key", F.lit(page).alias("page_number"), _text(pieces).alias("text"))


@query(f"""
WITH {NUMBERS_SQL}
SELECT doc_key, 'insert' AS kind, 'A' AS code, c::VARCHAR AS value FROM n UNION ALL SELECT doc_key, 'insert', 'B', e::VARCHAR FROM n UNION ALL SELECT doc_key, 'finish', f, finish FROM n
UNION ALL SELECT doc_key, 'dimension', 'A', (a::INT / 1000.0)::VARCHAR FROM n UNION ALL SELECT doc_key, 'dimension', 'B', ((1000 + b::INT) / 1000.0)::VARCHAR FROM n
UNION ALL SELECT doc_key, 'termination', '01', (a::INT / 1000.0)::VARCHAR FROM n UNION ALL SELECT doc_key, 'termination', '02', (b::INT / 1000.0)::VARCHAR FROM n
UNION ALL SELECT doc_key, 'hardware', h, hardware FROM n UNION ALL SELECT doc_key, 'part', 'M83513/' || lpad(m, 2, '0') || '-AN', '' FROM n
UNION ALL SELECT doc_key, 'figure', p_size::VARCHAR, p_name FROM n UNION ALL SELECT doc_key, 'figure', '777', '' FROM n
""")
def x_number_pairs(spark, d):
    """Pairs read from every part's page: inserts, finishes, the first of each dimension, options, part numbers and figures."""
    p = _pages(spark, d).withColumn("pin", t.pin_block("text"))
    pair = lambda kind, arr, code, value: p.select("doc_key", F.lit(kind).alias("kind"), F.explode(arr).alias("x")).select("doc_key", "kind", F.expr(code).alias("code"), F.expr(value).alias("value"))
    sizes = F.transform(F.map_entries(extract.dimension_hits("text")), lambda x: F.struct(x["key"].alias("k"), x["value"].alias("v")))
    out = [
        pair("insert", extract.insert_map("pin"), "x.insert_arrangement", "cast(x.cavity_count as string)"), pair("finish", extract.finish_map("pin"), "x.code", "x.description"),
        pair("dimension", sizes, "x.k", "cast(x.v as string)"), pair("termination", extract.termination_options("text"), "x.code", "cast(x.length_inches as string)"),
        pair("hardware", extract.hardware_codes("text"), "x.code", "x.description"), pair("part", extract.example_parts("text"), "x", "''"),
        pair("figure", extract.figure_references("text"), "cast(x.figure_number as string)", "coalesce(x.title, '')"),
    ]
    return reduce(DataFrame.unionByName, out)


@query(f"""
WITH {NUMBERS_SQL}, p AS (SELECT *, lpad(m, 2, '0') AS m2 FROM n), x AS (SELECT *, {_text_sql(_FIRST)} AS text FROM p)
SELECT doc_key, 1 AS page_number, length(text)::INT AS text_length,
  array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda l: length(l) BETWEEN 3 AND 100 AND ((upper(l) = l AND regexp_matches(l, '[A-Z]')) OR regexp_matches(upper(l), 'HOW TO ORDER|DIMENSIONS|FIGURE|REQUIREMENTS|NOTES'))), lambda l: upper(l)), '|') AS headers,
  'A=' || (a::INT / 1000.0)::VARCHAR || ',B=' || ((1000 + b::INT) / 1000.0)::VARCHAR AS dimensions,
  array_to_string(list_filter({_list_sql(dims.CAVITIES)}, lambda v: regexp_matches(text, '\\b' || v || '\\b')), ',') AS cavities,
  'M83513/' || m2 || '-AN' AS parts, 'MIL-DTL-83513/' || m AS mates, 'Figure ' || p_size || ':' || p_name || ',Figure 777:' AS figures
FROM x
""")
def x_page_summary(spark, d):
    """What every part's page holds: headers, dimensions, cavity counts, part numbers, mating sheets and figures."""
    listed = lambda array, shown: F.coalesce(F.array_join(F.transform(array, shown), ","), F.lit(""))
    sizes = F.array_sort(F.map_entries("dimensions"))
    return extract.page_summary(_pages(spark, d)).select(
        "doc_key", "page_number", "text_length", F.array_join("headers", "|").alias("headers"), listed(sizes, lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))).alias("dimensions"),
        listed("cavity_counts", lambda x: x.cast("string")).alias("cavities"), F.array_join("example_parts", ",").alias("parts"), F.array_join("mates_with", ",").alias("mates"),
        listed("figures", lambda x: F.concat(x["label"], F.lit(":"), F.coalesce(x["title"], F.lit("")))).alias("figures"),
    )


@query(f"""
WITH {NUMBERS_SQL}
SELECT doc_key, 'pcb' AS class, 'M83513/' || doc_key AS prefix, 'insert_arrangement,termination_length_code,shell_finish_code,hardware_code' AS components, 'A=' || c || ',B=' || e AS inserts, f || '=' || finish AS finishes,
  '01=' || (a::INT / 1000.0)::VARCHAR || ',02=' || (b::INT / 1000.0)::VARCHAR AS terminations, h || '=' || hardware AS hardware FROM n
""")
def x_pin_components(spark, d):
    """How every document's part numbers are made up, with the codes of each place."""
    listed = lambda array, code, value: F.coalesce(F.array_join(F.transform(array, lambda x: F.concat(x[code], F.lit("="), x[value].cast("string"))), ","), F.lit(""))
    return extract.pin_components(_pages(spark, d)).select(
        "doc_key", "class", "prefix", F.array_join("components", ",").alias("components"), listed("insert_arrangements", "insert_arrangement", "cavity_count").alias("inserts"),
        listed("finishes", "code", "description").alias("finishes"), listed("termination_options", "code", "length_inches").alias("terminations"), listed("hardware_options", "code", "description").alias("hardware"),
    )


@query(f"""
WITH {NUMBERS_SQL}, line AS (SELECT doc_key, c, {_SHELL.format(c="c")} AS shell, a::INT / 1000.0 AS x, list_sort([b::INT / 1000.0, 0.3, 0.2]) AS rest, 1 AS place FROM n WHERE k % 3 = 0
  UNION ALL SELECT doc_key, e, {_SHELL.format(c="e")}, b::INT / 1000.0, list_sort([a::INT / 1000.0, 0.4, 0.1]), 2 FROM n WHERE k % 3 = 0),
board AS (SELECT doc_key, c, a::INT / 1000.0 AS x, b::INT / 1000.0 AS y, 0.308 AS z, 1 AS place FROM n WHERE k % 3 = 1 UNION ALL SELECT doc_key, e, b::INT / 1000.0, a::INT / 1000.0, 0.309, 2 FROM n WHERE k % 3 = 1),
kept AS (SELECT *, row_number() OVER (PARTITION BY doc_key, c ORDER BY place DESC) AS n FROM line), kept2 AS (SELECT *, row_number() OVER (PARTITION BY doc_key, c ORDER BY place DESC) AS n FROM board)
SELECT doc_key, 1 AS page_number, c AS cavity_count, shell AS shell_letter, x::DOUBLE AS a, rest[1]::DOUBLE AS b, rest[2]::DOUBLE AS c, rest[3]::DOUBLE AS d FROM kept WHERE n = 1
UNION ALL SELECT doc_key, 1, c, NULL, x::DOUBLE, y::DOUBLE, NULL, z::DOUBLE FROM kept2 WHERE n = 1
UNION ALL SELECT doc_key, 1, c, {_SHELL.format(c="c")}, NULL, NULL, NULL, NULL FROM n WHERE k % 3 = 2
""")
def x_table_rows(spark, d):
    """Rows of geometry tables: lines of decimals for a third of the parts, board tables for another; rows are made up for the last, which has none."""
    rows = _numbers(spark, d)
    shell = lambda c: F.when(F.col(c) == 51, "B").when(F.col(c) == 100, "C").otherwise("A")
    one = F.concat_ws(" ", F.col("c").cast("string"), shell("c"), F.concat(F.lit("0."), "a"), F.concat(F.lit("0."), "b"), F.lit(".3 .2"))
    two = F.concat_ws(" ", F.col("e").cast("string"), shell("e"), F.concat(F.lit("0."), "b"), F.concat(F.lit("0."), "a"), F.lit(".4 .1"))
    lines = rows.where("p_partkey % 3 = 0").select("doc_key", F.lit(1).alias("page_number"), F.concat(F.lit("A table\n"), one, F.lit("\n"), two).alias("text"))
    boards = _pages(spark, d, _TABLE).join(rows.where("p_partkey % 3 = 1").select("doc_key"), "doc_key", "left_semi")
    inserts = rows.where("p_partkey % 3 > 0").select("doc_key", F.col("c").alias("cavity_count"))
    found = extract.geometry_rows(lines).drop("ordinal").unionByName(extract.with_synthesized(extract.pcb_rows(boards), inserts))
    return found.select("doc_key", "page_number", "cavity_count", "shell_letter", *[F.try_element_at("dimensions", F.lit(x.upper())).alias(x) for x in "abcd"])


@query(f"""
WITH {NUMBERS_SQL} SELECT doc_key, 'mating_hardware' AS context, (k % 7 + 1.5)::DOUBLE AS min_in_lbf, (k % 7 + 1.5)::DOUBLE AS max_in_lbf, '#2-56' AS thread, 'Metal shell' AS scope FROM n
UNION ALL SELECT doc_key, 'mounting_hardware', (p_size % 9 + 1)::DOUBLE, (p_size % 9 + 3)::DOUBLE, NULL, NULL FROM n
""")
def x_torque(spark, d):
    """A range and a value for a thread from every part's torque page."""
    return extract.torque_facts(_pages(spark, d, _TORQUE, 6)).select("doc_key", "context", "min_in_lbf", "max_in_lbf", "thread", "scope")


@query(f"""
WITH {NUMBERS_SQL} SELECT doc_key, '01' AS wire_code, 'M22759/11-26-9' AS wire_spec, (p_size + 10)::DOUBLE AS length_in, '1,2' AS refs, 'These connectors are fine.|For space applications only by ' || p_name AS notes, TRUE AS space_approved FROM n
UNION ALL SELECT doc_key, '02', 'M22759/33-26-9', 0.5::DOUBLE, '1,7', 'These connectors are fine.', FALSE FROM n
""")
def x_notes(spark, d):
    """Wire options of every part's sixth page with their notes; what the first page says doesn't count."""
    early = _numbers(spark, d).select("doc_key", F.lit(1).alias("page_number"), F.lit("01 = M22759/99-99-9 18 1/").alias("text"))
    found = extract.wire_options(early.unionByName(_pages(spark, d, _WIRES, 6)))
    return found.select("doc_key", "wire_code", "wire_spec", "length_in", F.array_join("note_refs", ",").alias("refs"), F.array_join("note_texts", "|").alias("notes"), "space_approved")


@query(f"""
WITH {NUMBERS_SQL} SELECT doc_key, CASE WHEN k % 5 = 0 THEN 'none' ELSE 'MIL-DTL-83513/' || m || 'H' END AS spec_sheet, CASE WHEN k % 5 = 0 THEN 'empty' WHEN k % 3 = 0 THEN 'fail' ELSE 'pass' END AS state,
  CASE WHEN k % 5 = 0 OR k % 3 = 0 THEN 0 ELSE 2 END AS n_inserts, CASE WHEN k % 5 = 0 THEN 0 ELSE 2 END::BIGINT AS n_figures, CASE WHEN k % 5 = 0 THEN 0 ELSE 2 END::BIGINT AS n_torque, CASE WHEN k % 5 = 0 THEN '' ELSE '01,02' END AS wires,
  CASE WHEN k % 5 = 0 OR (k % 3 = 0 AND k % 4 = 1) THEN 0 WHEN c = e THEN 1 ELSE 2 END::BIGINT AS n_configs FROM n
""")
def x_document_records(spark, d):
    """Whole records of all parts' documents from up to four pages each; every fifth has none, and every third names no inserts, which is a failed check. The header on the first page wins over the given spec sheet."""
    boards = _pages(spark, d, _TABLE, 2).where("(cast(doc_key as int) - 10) % 4 != 1")
    third = (F.col("doc_key").cast("int") - 10) % 3 == 0
    first = _pages(spark, d).where(~third).unionByName(_pages(spark, d, _BARE).where(third))
    pages = reduce(DataFrame.unionByName, [first, boards, _pages(spark, d, _TORQUE, 3), _pages(spark, d, _WIRES, 6)]).where("(cast(doc_key as int) - 10) % 5 != 0")
    sources = _numbers(spark, d).select("doc_key", F.concat(F.lit("Connectors, "), "p_name").alias("title"), F.lit("none").alias("spec_sheet"), F.lit("A").alias("revision"))
    r = extraction.records(spark, pages, sources)
    state = F.when(F.col("n_pages") == 0, "empty").when(F.exists("checks", lambda c: c["status"] == "fail"), "fail").otherwise("pass")
    return r.select("doc_key", "spec_sheet", state.alias("state"), F.size("inserts").alias("n_inserts"), "n_figures", "n_torque", F.array_join("wire_codes", ",").alias("wires"), "n_configs")


_LETTER = "chr((65 + o_orderkey % 26)::INT)"


@query(f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey::VARCHAR AS page, o_orderkey || '.1' AS token, 'Revision ' || {_LETTER} || CASE WHEN o_orderkey % 3 = 0 THEN ', Amendment ' || o_orderkey % 9 ELSE '' END AS description, strftime(o_orderdate, '%Y-%m-%d') AS document_date,
  {_LETTER} AS revision_letter, i::INT AS ordinal FROM o WHERE o_orderkey % 5 <> 0
""")
def x_revisions(spark, d):
    """Every customer's orders as rows of a page of history, read back; notices among them aren't revisions."""
    k = F.col("o_orderkey")
    letter = F.char(65 + k % 26)
    described = F.when(k % 5 == 0, F.concat(F.lit("Notice "), (k % 9).cast("string"), F.lit(" - Validation"))).otherwise(F.concat(F.lit("Revision "), letter, F.when(k % 3 == 0, F.concat(F.lit(", Amendment "), (k % 9).cast("string"))).otherwise("")))
    row = F.concat(F.lit('<tr><td><a href="r?token='), k.cast("string"), F.lit('.1">x</a></td><td>'), described, F.lit("</td><td>A</td><td>"), F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")), F.lit("</td></tr>"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), row.alias("row")))), lambda x: x["row"]), "")
    pages = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("page")).agg(F.concat(F.lit("<table>"), listed, F.lit("</table>")).alias("html"))
    return web.revision_entries(pages).withColumn("document_date", F.col("document_date").cast("string"))


_WIRES_OF = {"03": 58, "04": 58, "08": 22, "09": 58}


@query(f"""
WITH s AS (SELECT lpad(s_suppkey::VARCHAR, 2, '0') AS k, s_suppkey FROM supplier WHERE s_suppkey BETWEEN 1 AND 9), li AS (SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY 1),
rows(k, n) AS (VALUES {", ".join(f"('{k}', {n})" for k, n in dims.CONFIG_COUNTS.items())}), ins(k, inserts) AS (VALUES {", ".join(f"('{k}', '{','.join(dims.INSERTS[k[1]])}')" for k in ("02", "04"))}),
ws(k, want, per) AS (VALUES {", ".join(f"('{k}', {n}, {_WIRES_OF[k]})" for k, n in dims.WIRE_COUNTS.items())}),
found AS (
  SELECT '/' || k || ' has ' || n || ' staged rows' AS name, n::VARCHAR AS want, CASE WHEN s_suppkey IS NULL THEN '0' ELSE n::VARCHAR END AS got FROM rows LEFT JOIN s USING (k)
  UNION ALL SELECT '/' || k || ' has inserts ' || inserts, inserts, CASE WHEN s_suppkey IS NULL THEN '' ELSE inserts END FROM ins LEFT JOIN s USING (k)
  UNION ALL SELECT '/' || k || ' has ' || want || ' staged wires', want::VARCHAR, (CASE WHEN s_suppkey IS NULL THEN 0 ELSE want // per * least(per, coalesce(lines, 0)) END)::VARCHAR FROM ws LEFT JOIN s USING (k) LEFT JOIN li ON l_suppkey = s_suppkey
  UNION ALL SELECT '/' || k || ' has finishes ', '', '' FROM rows WHERE k IN ('06', '07', '08', '09')
  UNION ALL SELECT name, want, got FROM (VALUES ('/02 inherits verified torque', '1', 2), ('/04 inherits verified torque', '1', 4), ('/05 owns six facts', '1', 5)) v(name, want, sheet), LATERAL (SELECT count(*)::VARCHAR AS got FROM supplier WHERE s_suppkey = sheet) c
)
SELECT name, CASE WHEN got = want THEN 'pass' ELSE 'fail' END AS status, got AS details FROM found
""")
def q_edge_checks(spark, d):
    """The 21 checks of a rebuild: suppliers 1 to 9 stand for the sheets that there are, and their first order lines for wires."""
    there = table(spark, d, "supplier").where("s_suppkey between 1 and 9").select(F.col("s_suppkey").cast("string").alias("doc_key"))
    configs = variants.configurations(_records(spark).join(there, "doc_key", "left_semi"), spark.createDataFrame([], NO_SHAPES))
    per = spark.createDataFrame(list(_WIRES_OF.items()), "slash_sheet string, per int")
    place = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    lines = table(spark, d, "lineitem").where("l_suppkey in (3, 4, 8, 9)").select(F.lpad(F.col("l_suppkey").cast("string"), 2, "0").alias("slash_sheet"), place.alias("place")).where("place <= 58")
    wires = configs.select("slash_sheet").join(lines.join(F.broadcast(per), "slash_sheet").where("place <= per").select("slash_sheet", "place"), "slash_sheet")
    sheets = there.where("doc_key in ('2', '4', '5')").select(F.lpad("doc_key", 2, "0").alias("slash_sheet"))
    resolved = sheets.select("slash_sheet", F.lit(6).alias("fact_count"), (F.col("slash_sheet") != "05").alias("values_inherited"), F.lit(True).alias("values_verified"), F.lit(False).alias("needs_review"), F.when(F.col("slash_sheet") == "05", "owns_profile").otherwise("references_other_doc").alias("torque_mode"))
    return quality.edge_checks(spark, quality.summary_by_sheet(configs, wires), resolved)
