"""Mixing sources to target weights: repetition rates per source, whole copies plus one Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fresh, materialize, own_columns, prefix_sums, small_side

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is this many times its size at most.
MOST = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words() -> Column:
    """The number of words in the column text; null: 0."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds `target` to a table (source, source_size) with one row a source.

    All targets sum to the sum of all sizes and are in proportion to the weights, except that a target
    stops at `most` times its source's size; what that leaves is shared again by weight among the others.
    Ranks and the level of sharing come from prefix sums without a global window, so any number of sources will do:
    with the sources in the order of cap over weight, the level is the largest quotient of what the caps before
    leave and the weights from there on.
    """
    cases = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    ranked = materialize(
        prefix_sums(sizes, [F.col("source").asc_nulls_last()], {"before": "source_size"}).select(
            "source", "source_size", F.col("idx").alias("place"), F.col("before_total").alias("total"),
            cases.cast("double").alias("weight"), (F.col("source_size").cast("double") * most).alias("cap"),
        ),
        "sources",
    )
    ordered = prefix_sums(ranked, [F.col("cap") / F.col("weight"), F.col("place")], {"caps": "cap", "weights": "weight"})
    level = ordered.agg(F.max((F.col("total") - F.col("caps")) / (F.col("weights_total") - F.col("weights"))).alias("level")).first()["level"] or 0.0
    return ranked.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def _rated(docs: DataFrame, sizes: DataFrame, weights, most: int, seed: str) -> tuple[DataFrame, str]:
    """`docs` with one more column, and its name: a struct of source, source_size, target and copies."""
    name = fresh(docs, "mix")
    targets = source_targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")
    targets = targets.select(F.struct("source", "source_size", "target", rate).alias(name))
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(16**13)
    rate = F.col(f"{name}.rate")
    copies = (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    out = docs.join(small_side(targets), docs["source"].eqNullSafe(F.col(f"{name}.source")))
    return out.withColumn(name, F.col(name).withField("copies", copies)), name


def _sizes(docs: DataFrame, size: Column) -> DataFrame:
    return docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED, size: Column | None = None) -> DataFrame:
    """Adds size, source_size, target and copies to each row of `docs`; a column that has one of these names is replaced.

    Size: words in the text (null: 0), or the given column. A source's repetition rate is its target over its size; a document
    is taken floor(rate) times, and once more with a probability equal to the fraction, drawn from the MD5
    of the seed and its doc_id (so reruns agree, and rows that repeat a doc_id draw alike). Null is a source
    of its own, the last; a source without words has target 0 and no copies; an empty table gives no rows.
    All other columns stay, whatever their names.
    """
    size = words() if size is None else size
    out, name = _rated(docs, _sizes(docs, size), weights, most, seed)
    added = [F.col(f"{name}.{c}").alias(c) for c in ("source_size", "target", "copies")]
    return out.select(*own_columns(docs, ("size", "source_size", "target", "copies")), size.alias("size"), *added)


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED, size: Column | None = None) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with its own columns as they are."""
    out, name = _rated(docs, _sizes(docs, words() if size is None else size), weights, most, seed)
    every = F.explode(F.sequence(F.lit(1), F.col(f"{name}.copies"))).alias(name)
    return out.where(F.col(f"{name}.copies") > 0).select(*own_columns(docs), every).select(*own_columns(docs))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of all documents. Texts are read once; what follows reads doc_id, source and size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = materialize(docs.select("doc_id", "source", words().alias("size")), "sizes")
    return mix(sized, size=F.col("size")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source
), w AS (
  SELECT *, CASE rk % {len(WEIGHTS)} {" ".join(f"WHEN {i} THEN {w}.0" for i, w in enumerate(WEIGHTS))} END::DOUBLE AS weight,
    {MOST}.0::DOUBLE * source_size AS cap FROM s
), c AS (
  SELECT *, sum(cap) OVER f - cap AS cap_before, sum(weight) OVER () - (sum(weight) OVER f - weight) AS weight_left,
    sum(source_size) OVER () AS total
  FROM w WINDOW f AS (ORDER BY cap / weight, rk ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT *, max((total - cap_before) / weight_left) OVER () AS level FROM c
), t AS (
  SELECT source, source_size, least(cap, weight * level)::DOUBLE AS target,
    CASE WHEN source_size > 0 THEN least(cap, weight * level) / source_size ELSE 0 END AS rate FROM l
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {16**13}.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
