"""Scans behind a service, deep pages, ranges, indexes, differences and tables kept current, over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import diffs, inverted, paging, ranges
from ..operators.relational import gap_runs
from ..sources import rest
from ..sources.log import KeyedTable
from ..sources.tables import table
from ..streaming import events as streams
from ..streaming import modes
from .base import PARTS_SQL, configurations, query
from .scratch import scratch
from .served import service_of

# --- a table behind a service


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 50000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 3 = 0")
def s_rest_scan(spark, d):
    """Orders from a REST service: three conditions and the columns go into its requests, the fourth stays with Spark; a task a page."""
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string"
    orders = rest.rest_table(spark, service_of(d).url, "orders", schema, order="o_orderkey")
    rows = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 50000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderkey") % 3 == 0))
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS total_size FROM part WHERE p_name LIKE '%a%' AND p_size IS NOT NULL AND NOT p_brand = 'Brand#1' GROUP BY p_brand")
def s_rest_paged(spark, d):
    """Parts from the service with a pattern, a null test and a negated equality in the request."""
    parts = rest.rest_table(spark, service_of(d).url, "part", "p_partkey long, p_name string, p_brand string, p_size int", order="p_partkey", pageSize=500)
    rows = parts.where(F.col("p_name").contains("a") & F.col("p_size").isNotNull() & (F.col("p_brand") != "Brand#1"))
    return rows.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("total_size"))


# --- pages

_LINES = ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""
SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, total FROM (
  SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place, count(*) OVER () AS total FROM lineitem)
WHERE place > total * 5 // 6 AND place <= total * 5 // 6 + 50
""")
def o_deep_page(spark, d):
    """Fifty lines behind five sixths of all lines by falling price, with the total; only parts that hold the page are sorted."""
    lines = table(spark, d, "lineitem")
    page = paging.rank_page(lines, _LINES, 50, lines.count() * 5 // 6, piece=2000)
    return page.rows.select("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.lit(page.total).cast("long").alias("total"))


@query("""
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders), (SELECT count(*) // 2 AS half FROM orders) WHERE place > half AND place <= half + 20
""")
def o_next_page(spark, d):
    """The page behind the last key that was seen, which is the one in the middle."""
    orders = table(spark, d, "orders")
    seen = paging.rank_page(orders, ["o_custkey", "o_orderkey"], 1, orders.count() // 2 - 1, piece=2000).rows.first()
    return paging.after(orders, ["o_custkey", "o_orderkey"], (seen["o_custkey"], seen["o_orderkey"]), 20).select("o_orderkey", "o_custkey")


# --- ranges

_RANGES_SQL = "ranges AS (SELECT o_orderkey, round(o_totalprice / 10, 1) AS lo, round(o_totalprice / 10, 1) + o_custkey % 8 AS hi FROM orders)"


@query(f"WITH {_RANGES_SQL} SELECT o_orderkey, count(*) AS n, min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM ranges JOIN lineitem ON l_extendedprice BETWEEN lo AND hi GROUP BY o_orderkey")
def j_in_ranges(spark, d):
    """Every order gives a range of prices, and ranges overlap: the order lines in each."""
    lo = F.round(F.col("o_totalprice") / 10, 1)
    given = table(spark, d, "orders").select("o_orderkey", lo.alias("lo"), (lo + F.col("o_custkey") % 8).alias("hi"))
    met = ranges.in_ranges(table(spark, d, "lineitem").select("l_extendedprice"), given, "l_extendedprice")
    return met.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"))


@query("""
SELECT l_suppkey, first_missing, last_missing FROM (
  SELECT l_suppkey, l_partkey + 1 AS first_missing, lead(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1 AS last_missing FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
WHERE last_missing >= first_missing
""")
def j_gap_runs(spark, d):
    """The runs of parts between a supplier's first and last that it doesn't deliver."""
    return gap_runs(table(spark, d, "lineitem"), "l_suppkey", "l_partkey")


# --- indexes

_NEEDLES = ["red", "BRAND#1", "3-A", "M83513/0", "%", "_", "a", "is", "#2 ", "no such text"]


@query(f"""
WITH {PARTS_SQL}, needles(needle) AS (SELECT unnest({_NEEDLES!r}))
SELECT needle, config_id FROM needles, parts WHERE contains(lower(name), lower(needle)) OR contains(lower(description), lower(needle)) OR contains(lower(spec_sheet), lower(needle)) OR contains(lower(example_pin), lower(needle))
""")
def p_substring_index(spark, d):
    """Needles looked up in four columns by lists of three-character runs; those of one or two characters by a scan."""
    parts, columns = configurations(spark, d).select("config_id", "name", "description", "spec_sheet", "example_pin"), ["name", "description", "spec_sheet", "example_pin"]
    index = inverted.substring_index(parts, "config_id", columns, scratch(spark))
    found = [inverted.search_substring(parts, "config_id", columns, index, n).select(F.lit(n).alias("needle"), "config_id") for n in _NEEDLES]
    return reduce(DataFrame.unionByName, found)


_PARTS_OF = {
    '{"lang":"fr","size":{"tail":3}}': "lang = 'fr' AND n_chars % 10 = 3",
    '{"tags":[{"l":"en","r":1}]}': "lang = 'en' AND n_chars % 3 = 1",
    '{"tags":[{"l":"src3"},{"r":1}]}': "source = 'src3' AND (n_chars % 3 = 1 OR n_chars % 5 = 1)",
    '{"size":{}, "lang":"de"}': "lang = 'de'",
    '{"lang":"none"}': "false",
}


@query(" UNION ALL ".join(f"SELECT '{part}' AS part, doc_id FROM documents WHERE {sql}" for part, sql in _PARTS_OF.items()))
def p_json_contains(spark, d):
    """Documents as JSON, and those that contain a value, at any depth, by lists of what each says."""
    tag = lambda name, k: F.struct(F.col(name).alias("l"), (F.col("n_chars") % k).alias("r"))
    value = F.to_json(F.struct("doc_id", "lang", "source", F.struct((F.col("n_chars") % 10).alias("tail")).alias("size"), F.array(tag("lang", 3), tag("source", 5)).alias("tags")))
    docs = table(spark, d, "documents").select("doc_id", value.alias("value"))
    index = inverted.json_index(docs, "doc_id", "value", scratch(spark))
    found = [inverted.search_json(docs, "doc_id", "value", index, part).select(F.lit(part).alias("part"), "doc_id") for part in _PARTS_OF]
    return reduce(DataFrame.unionByName, found)


# --- differences and tables kept current


@query("""
SELECT o_orderkey AS key, 'lost' AS kind FROM orders WHERE o_orderkey % 1000 = 7 UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 1500 = 11 AND o_orderkey % 1000 <> 7
UNION ALL SELECT o_orderkey + 100000000, 'added' FROM orders WHERE o_orderkey % 2000 = 3
""")
def v_tree_diff(spark, d):
    """What was added to, lost from and changed in a copy of the orders, by checksums of key ranges."""
    orders = table(spark, d, "orders")
    k = F.col("o_orderkey")
    other = orders.where(k % 1000 != 7).withColumn("o_totalprice", F.when(k % 1500 == 11, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    other = other.unionByName(orders.where(k % 2000 == 3).withColumn("o_orderkey", k + 100_000_000))
    shape, root = diffs.Shape("o_orderkey", leaf=64), scratch(spark)
    sums = []
    for name, rows in (("before", orders), ("after", other)):  # as they are stored beside snapshots
        diffs.checksums(rows, shape).write.parquet(f"{root}/{name}")
        sums.append(spark.read.parquet(f"{root}/{name}"))
    return diffs.tree_diff(orders, other, shape, *sums)


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1")
def v_upsert_incremental(spark, d):
    """The newest event of each user, kept current over seven additions in no order; full buckets are merged on the way."""
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    kept = KeyedTable(spark, scratch(spark), rows.schema, "user_id", "ts", "event_id", buckets=8, most=3)
    for i in range(7):
        kept.add(rows.where(F.col("event_id") % 7 == i), i)
    return kept.read().select("user_id", "event_id", "event_type", "value")


_ALLOWED = [("view", "click"), ("click", "purchase"), ("signup", "view"), ("view", "view")]


@query("""
WITH s AS (SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state, event_type AS to_state FROM events)
SELECT user_id::VARCHAR AS user_id, event_id, from_state, to_state FROM s WHERE from_state IS NOT NULL AND (from_state, to_state) NOT IN (('view', 'click'), ('click', 'purchase'), ('signup', 'view'), ('view', 'view'))
""")
def v_state_stream(spark, d):
    """Steps of users that aren't allowed, found by a stream with one state a user, which reads the events in four files by time."""
    folder = scratch(spark)
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    ends = rows.agg(F.expr("percentile_approx(event_id, array(0.25, 0.5, 0.75))").alias("p")).first()["p"]
    for i, (lo, hi) in enumerate(zip([None, *ends], [*ends, None], strict=True)):  # event_id rises with time
        part = rows.where((F.lit(True) if lo is None else F.col("event_id") > lo) & (F.lit(True) if hi is None else F.col("event_id") <= hi))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in/part={i}")
    source = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    out = modes.rejected_steps(source, "user_id", "ts", "event_id", "event_type", _ALLOWED)
    streams.run_once(out, f"{folder}/out", f"{folder}/checkpoint")
    found = spark.read.schema(out.schema).parquet(f"{folder}/out")
    return found.where("outcome = 'rejected'").select(F.col("key").alias("user_id"), "event_id", "from_state", "to_state")
