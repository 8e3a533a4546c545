"""Sharding: contiguous shards of near-equal bytes, cut on global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import prefix_sums

N_SHARDS = 24
#: Bytes added to each text, as for a record header.
OVERHEAD = 8


def balanced_shards(docs: DataFrame, n_shards: int = N_SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """Put every row into one of `n_shards` shards, contiguous in doc_id order, of near-equal bytes.

    A row's size is its text's UTF-8 bytes plus `overhead`. With B the sum of all sizes before a row
    (rows ordered by doc_id, then size and crc32), the row goes to the shard in whose 1/n of the total
    the middle of [B, B + size) falls, so a shard is off its target by one document's size at most.
    Only (doc_id, size, crc32) is shuffled; texts stay in the scan.

    Null texts count as empty; null doc_ids come first; repeated rows are separate rows next to each
    other; an empty table gives no rows; shards stay empty when there are fewer documents than shards.
    Rows with equal texts are not kept together: the law is equal bytes. Other columns are ignored.

    Returns doc_id, size, text_crc32, shard, slot (from 0 without gaps in each shard).
    """
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    placed = prefix_sums(rows, order, {"before": "size"}).withColumn(
        "shard", F.expr(f"cast(least({n_shards - 1}, (2 * before + size) * {n_shards} div (2 * before_total)) as int)")
    )
    first = placed.groupBy("shard").agg(F.min("idx").alias("first_idx"))  # a row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("idx") - F.col("first_idx")).cast("long").alias("slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law `bytes`."""
    return balanced_shards(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8
), d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + {OVERHEAD} AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT doc_id, size,
    xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT),
        lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM d, crc_table
), p AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    (sum(size) OVER ())::BIGINT AS total
  FROM c
), s AS (
  SELECT *, least({N_SHARDS - 1}, (2 * before + size) * {N_SHARDS} // (2 * total))::INTEGER AS shard FROM p
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY before, size, text_crc32) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s
"""
