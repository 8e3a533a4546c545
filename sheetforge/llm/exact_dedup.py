"""Exact duplicates: composable polynomial fingerprints, then a chunkwise comparison of equal ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import utf8
from ._common import bounded_batches, materialize, own_columns, small_side

#: (modulus, base) of the two fingerprints; both moduli are primes under 2**31.
FIELDS = ((2147483647, 1306215917), (2147483629, 1822093481))
#: Bytes in a chunk; products of a byte and a power under 2**31 can't overflow in a sum of so many.
CHUNK = 1 << 16
#: Longer texts are hashed chunk by chunk in separate rows.
HUGE = 1 << 22
#: Rows of one group that are compared with one copy of its representative.
PER_COPY = 512
_FP = ["fp1", "fp2", "n_bytes"]


def _falling_powers(modulus: int, base: int) -> np.ndarray:
    out = np.empty(CHUNK, np.uint64)
    x = 1
    for i in range(CHUNK - 1, -1, -1):
        out[i] = x
        x = x * base % modulus
    return out


def chunk_hash(data: np.ndarray, field: tuple[int, int], table: np.ndarray) -> int:
    """Sum of byte i times base**(n-1-i), of one chunk."""
    return int(np.dot(data.astype(np.uint64), table[CHUNK - len(data) :])) % field[0] if len(data) else 0


def combine(left: int, right: int, right_bytes: int, field: tuple[int, int]) -> int:
    """The hash of two pieces joined: the left one shifted by the right one's length, plus the right one."""
    return (left * pow(field[1], right_bytes, field[0]) + right) % field[0]


def _hash_rows(fields):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [_falling_powers(*f) for f in fields]
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out = np.zeros((len(fields), batch.num_rows), np.int64)
            for i in range(batch.num_rows):
                for at in range(offsets[i], offsets[i + 1], CHUNK):
                    piece = data[at : min(at + CHUNK, offsets[i + 1])]
                    for k, (f, t) in enumerate(zip(fields, tables, strict=True)):
                        out[k, i] = combine(int(out[k, i]), chunk_hash(piece, f, t), len(piece), f)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(np.diff(offsets)), pa.array(out[0]), pa.array(out[1])],
                names=[*rest, "n_bytes", "fp1", "fp2"],
            )

    return run


def _hash_chunks(fields):
    """Each chunk's hash, already shifted by the bytes that follow it in its text; the sums of these are the texts' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [_falling_powers(*f) for f in fields]
        for batch in batches:
            data, offsets = utf8(batch.column("chunk"))
            after = batch.column("after").to_pylist()
            out = [
                [chunk_hash(data[offsets[i] : offsets[i + 1]], f, t) * pow(f[1], after[i], f[0]) % f[0] for i in range(batch.num_rows)]
                for f, t in zip(fields, tables, strict=True)
            ]
            rest = [c for c in batch.schema.names if c not in ("chunk", "after")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=[*rest, "fp1", "fp2"]
            )

    return run


def _chunks(column: str) -> str:
    n = f"octet_length({column})"
    return (
        f"transform(sequence(0, greatest(0, ({n} - 1) div {CHUNK})), i -> struct(i as pos, "
        f"greatest(0L, {n} - (i + 1L) * {CHUNK}) as after, substring(cast({column} as binary), i * {CHUNK} + 1, {CHUNK}) as chunk))"
    )


def fingerprints(rows: DataFrame, fields=FIELDS, huge: int = HUGE) -> DataFrame:
    """Replaces the column text (null: empty) by n_bytes, fp1 and fp2; other columns stay.

    Texts over `huge` bytes are dealt out as chunks, hashed in parallel and combined by a sum.
    """
    bounded_batches(rows.sparkSession)
    rest = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    size = F.octet_length("text")
    short = rows.where(size <= huge).mapInArrow(_hash_rows(fields), f"{schema}, n_bytes long, fp1 long, fp2 long")
    dealt = (
        rows.where(size > huge)
        .withColumn("_row", F.monotonically_increasing_id())  # before the rows are exploded
        .select(*rest, size.cast("long").alias("n_bytes"), "_row", F.expr(f"explode({_chunks('text')}) as c"))
        .select(*rest, "n_bytes", "_row", "c.*")
        .repartition("_row", "pos")
        .drop("pos")
        .mapInArrow(_hash_chunks(fields), f"{schema}, n_bytes long, _row long, fp1 long, fp2 long")
    )
    long = dealt.groupBy("_row", "n_bytes", *rest).agg(
        F.pmod(F.sum("fp1"), F.lit(fields[0][0])).alias("fp1"), F.pmod(F.sum("fp2"), F.lit(fields[1][0])).alias("fp2")
    )
    return short.unionByName(long.drop("_row"))


def _unequal(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Rows (fp1, fp2, n_bytes) of groups in which some text differs from the representative's, found chunk by chunk.

    members: doc_id, text_sha256, the group's key, its size and its representative (rep.doc_id, rep.text_sha256).
    A large group's representative is copied once for every PER_COPY rows, and the group dealt over the copies.
    """
    wanted = members.select("doc_id", "text_sha256", *_FP, "group_size", "rep").distinct()
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_sha", F.sha2("text", 256))
    parts = (
        texts.join(small_side(wanted), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_sha") == F.col("text_sha256")))
        .withColumn("copies", F.expr(f"cast((group_size + {PER_COPY - 1}) div {PER_COPY} as int)"))
        .withColumn("is_rep", F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_sha256") == F.col("rep.text_sha256")))
        .withColumn("copy", F.expr("cast(pmod(xxhash64(monotonically_increasing_id()), copies) as int)"))
        .select(*_FP, "copies", "is_rep", "copy", F.expr(f"explode({_chunks('text')}) as c"))
        .select(*_FP, "copies", "is_rep", "copy", "c.pos", "c.chunk")
    )
    rep = (
        parts.where("is_rep")
        .groupBy(*_FP, "copies", "pos")
        .agg(F.first("chunk").alias("rep_chunk"))
        .withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)")))
        .drop("copies")
    )
    return parts.join(rep, [*_FP, "pos", "copy"]).where(F.col("chunk") != F.col("rep_chunk")).select(*_FP).distinct()


def exact_duplicates(docs: DataFrame, fields=FIELDS, huge: int = HUGE) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Rows whose texts are identical (null counts as empty) form a group; the row with the largest doc_id stays.
    Texts are fingerprinted; groups of equal fingerprints are confirmed by comparing every text with the
    group's representative, chunk by chunk; a group in which one differs is split by SHA-256.
    Null doc_ids are smaller than any other; of rows that repeat the winner's doc_id and text one stays;
    keep_id is null if the whole group has no doc_id; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    fp = materialize(fingerprints(rows, fields, huge).withColumn("_uid", F.monotonically_increasing_id()), "fingerprints")

    def groups(key):
        best = F.max(F.struct("doc_id", "text_sha256", "_uid")).alias("rep")
        return fp_rows.groupBy(*key).agg(best, F.count("*").alias("group_size")).where("group_size > 1")

    fp_rows, key = fp, _FP
    found = materialize(groups(key), "groups")
    members = fp.join(small_side(found), _FP)
    differing = materialize(_unequal(docs, members), "unequal")
    if not differing.isEmpty():
        odd = small_side(differing.withColumn("_odd", F.lit(True)))
        fp_rows = fp.join(odd, _FP, "left").withColumn("_part", F.when(F.col("_odd"), F.col("text_sha256")).otherwise("")).drop("_odd")
        key = [*_FP, "_part"]
        found = materialize(groups(key), "groups")
    return fp_rows.join(small_side(found), key, "left").select(
        "doc_id",
        F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("rep._uid") == F.col("_uid"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with all its columns, one row of each group of equal texts: that with the largest doc_id.

    Of rows that repeat this doc_id and the text, the one whose other columns, as JSON, come first stays, so runs agree. Null texts are empty;
    a group without any doc_id keeps one row; an empty table gives no rows. Columns may have any names.
    """
    decided = materialize(exact_duplicates(docs), "decided")
    key = ["doc_id", "text_sha256"]
    lost = decided.where("not kept").select(*key).distinct()
    twice = decided.groupBy(*key).agg(F.count("*").alias("n"), F.max("kept").alias("stays")).where("n > 1 and stays").select(*key)
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)

    def same(other):
        return docs["doc_id"].eqNullSafe(other["doc_id"]) & (sha == other["text_sha256"])

    lost = small_side(lost)
    single = docs.join(lost, same(lost), "left_anti")
    if twice.isEmpty():
        return single
    rows = docs.join(twice, same(twice), "left_semi")
    own = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(own_columns(docs))])
    others = [c.alias(f"c{i}") for i, c in enumerate(own_columns(docs, ("text",)))]
    first = rows.groupBy(F.col("doc_id").alias("k1"), sha.alias("k2")).agg(F.min_by(own, F.to_json(F.struct(*others))).alias("row"))  # by partial minimums
    return single.union(first.select("row.*").toDF(*docs.columns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents; null, empty and repeated rows as in exact_duplicates."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
