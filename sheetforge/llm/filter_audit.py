"""Filter interaction audit: what each filter removes at each place of every order, from one CUBE over the failure flags."""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: The five filters, in the order of their letters.
FILTERS = ("A", "B", "C", "D", "E")
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = "[#$%&*|]"
#: Measures of the documents that a filter removes.
MEASURES = ("good", "toxic")


def text_flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, text_sha and the flags A to D of every row, from its whole text.

    Null texts are empty (A holds, the others don't); part is lang, null as the empty string.
    """
    own = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = own.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    return split.select(
        "doc_id", "part", F.sha2("text", 256).alias("text_sha"),
        (n < LEAST_WORDS).alias("A"), (100 * distinct < LEAST_DISTINCT * n).alias("B"),
        (100 * capitals.cast("long") > MOST_CAPITALS * F.length("text")).alias("C"), F.col("text").rlike(SYMBOLS).alias("D"),
    )


def repeats(flagged: DataFrame) -> DataFrame:
    """Adds the flag E: some smaller doc_id of the whole table has the same text (by SHA-256).

    Of a group only its smallest doc_id is gathered, by partial minimums, and joined back; the join's hot keys can be split.
    A row without doc_id is neither larger nor smaller than any other. Rows that repeat a doc_id are equal in this.
    """
    first = flagged.groupBy("text_sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("text_sha", "first")
    return flagged.join(first, "text_sha", "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("first", "text_sha")


def with_labels(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good (quality = 1) and toxic (toxic = 1); false without a label. Of several labels of a doc_id any will do."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    one = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    return flagged.join(known, "doc_id", "left").withColumns({"good": one("q"), "toxic": one("t")}).drop("q", "t")


def survivors(rows: DataFrame, flags: tuple[str, ...] = FILTERS, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """(whole, part, mask, n, and a count for each measure): the rows that fail no filter of the subset `mask`.

    Bit i of mask is flags[i]. Rows are counted by part, flags and measures first, so the CUBE works on a table that
    is bounded by the number of parts. Each grouping set gives a subset; of its rows that with all selected flags false
    counts its survivors, and a subset without such a row has 0. `whole` marks the grouping sets without part, whose part is empty.
    """
    cells = rows.groupBy("part", *flags).agg(F.count("*").alias("n"), *[F.count_if(m).alias(m) for m in measures])
    sums = [F.sum(c).alias(c) for c in ("n", *measures)]
    cube = cells.cube(*flags, "part").agg(*sums, F.grouping_id().alias("gid"))
    k = len(flags)
    selected = lambda i: F.shiftright("gid", k - i).bitwiseAND(F.lit(1)) == 0
    mask = reduce(Column.__add__, [F.when(selected(i), 1 << i).otherwise(0) for i in range(k)])
    clean = ~reduce(Column.__or__, [F.coalesce(F.col(f), F.lit(False)) for f in flags])
    whole = F.col("gid").bitwiseAND(F.lit(1)) == 1
    kept = cube.select(whole.alias("whole"), F.coalesce("part", F.lit("")).alias("part"), mask.alias("mask"), *[F.when(clean, F.col(c)).otherwise(0).alias(c) for c in ("n", *measures)])
    return kept.groupBy("whole", "part", "mask").agg(*sums)


def _transitions(spark: SparkSession, k: int) -> DataFrame:
    """(filter, before, after, orders): each subset and the one with one filter more, and how many orders pass through both; k * 2**(k-1) rows."""
    rows = [(i, s, s | 1 << i, factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())) for i in range(k) for s in range(1 << k) if not s >> i & 1]
    return spark.createDataFrame(rows, "filter int, before int, after int, orders long")


def _steps(spark: SparkSession, flags: tuple[str, ...]) -> DataFrame:
    """(filter_order, step, filter, before) of every permutation of the flags; k * k! rows."""
    rows = []
    for order in permutations(range(len(flags))):
        before = 0
        for step, i in enumerate(order):
            rows.append(("".join(flags[j] for j in order), step + 1, i, before))
            before |= 1 << i
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def audit(rows: DataFrame, flags: tuple[str, ...] = FILTERS, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """What every filter does at every step of every order, by part and (`whole`) for all parts together.

    rows: part, one boolean column a filter, one a measure; null counts as false. Result: whole, part, filter_order, step, kept (rows left after the
    step), removed (by it), redundant (rows that fail its filter and were removed before), unique_fails (rows that fail its
    filter only), <measure>_lost (of the removed), shapley (what its filter removes, summed over all orders).
    Pairs of subsets are joined: survivors before and after a step. All that follows the first count is bounded by the number of parts;
    the tables of steps and of pairs of subsets follow from the number of filters alone and are broadcast. An empty table gives no rows.
    """
    spark, k = rows.sparkSession, len(flags)
    plain = rows.select("part", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in (*flags, *measures)])
    left = materialize(survivors(plain, flags, measures), "survivors")
    counts = ("n", *measures)
    after = left.withColumnsRenamed({"mask": "after"} | {c: f"{c}_after" for c in counts}).join(F.broadcast(_transitions(spark, k)), "after")
    pairs = after.join(left.withColumnRenamed("mask", "before"), ["whole", "part", "before"])
    lost = [(F.col(c) - F.col(f"{c}_after")).alias("removed" if c == "n" else f"{c}_lost") for c in counts]
    pairs = materialize(pairs.select("whole", "part", "filter", "before", "orders", F.col("n_after").alias("kept"), *lost), "pairs")
    everything = (1 << k) - 1
    others = F.lit(everything) - F.expr("shiftleft(1, filter)")
    by_filter = pairs.groupBy("whole", "part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"),
    )
    steps = pairs.join(F.broadcast(_steps(spark, flags)), ["filter", "before"]).join(by_filter, ["whole", "part", "filter"])
    return steps.select(
        "whole", "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", *[f"{m}_lost" for m in measures], "shapley",
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of the five text filters A to E over whole texts, with the labels' good and toxic documents; texts are read once."""
    flagged = materialize(text_flags(docs), "flags")
    return audit(with_labels(repeats(flagged), labels))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of the five filters over all documents, by lang; null and empty texts, ties and repeated rows as in the parts above."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit_documents(docs, labels).where("not whole").drop("whole")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM t
), l AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), x(letter, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, s::INT AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS earlier FROM orders, range(1, 6) r(s)
), counted AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (fails & (earlier + bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & earlier = 0 AND fails & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & earlier > 0 AND fails & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & earlier = 0 AND fails & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & earlier = 0 AND fails & bit > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
"""
