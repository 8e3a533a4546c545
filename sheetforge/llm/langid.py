"""Language ID with bit-sliced Bloom filters: one look-up returns all languages that contain an n-gram."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._bytes import utf8
from ._common import bounded_batches, fresh, own_columns, small_side

#: Bytes in an n-gram.
N = 4
#: At most about so many labelled documents of each language are learned from, chosen by a hash of doc_id.
SAMPLE = 3000
#: At most so many n-grams of each language enter the filter, the most frequent first.
GRAMS = 60_000
#: An n-gram enters a language's filter if its rate there is at least this part of its highest rate in any language.
RATIO = 0.4
LEAST = 2
SLOTS = 1 << 21
HASHES = 3
UNKNOWN = "und"
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
#: Letters in lower case, bytes of longer characters as they are, all else a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
#: Bytes worked on at a time.
_BLOCK = 1 << 18


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The N-byte windows of one run of bytes as 32-bit numbers, and which of them count (no two spaces in a row)."""
    b = _FOLD[data]
    n = len(b) - N + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    out = np.zeros(n, np.uint32)
    for i in range(N):
        out = (out << np.uint32(8)) | b[i : i + n]
    double = (b[:-1] == 32) & (b[1:] == 32)
    bad = double[: n].copy()
    for i in range(1, N - 1):
        bad |= double[i : i + n]
    return out, ~bad


def blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, n-grams) of runs of whole rows, or of pieces of a long row; no n-gram runs over the end of a row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK, "right")) - 1)
        for at in range(offsets[row], max(offsets[last], offsets[row] + 1), _BLOCK):
            stop = min(offsets[last], at + _BLOCK + N - 1)
            g, ok = grams(data[at:stop])
            place = np.arange(at, at + len(g))
            rows = np.repeat(np.arange(row, last), np.diff(np.clip(offsets[row : last + 1], at, at + len(g))))
            ok &= place + N <= offsets[rows + 1]
            yield rows[ok], g[ok]
        row = last


def slots(g: np.ndarray, k: int) -> np.ndarray:
    x = g * _ODD[k]
    return ((x ^ (x >> np.uint32(15))) * _ODD[(k + 1) % len(_ODD)] >> np.uint32(7)) & np.uint32(SLOTS - 1)


@dataclass
class Model:
    """languages in order of their number; table[slot, word]: bit l % 64 is slot's bit in language l's filter."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def hits(self, rows: np.ndarray, g: np.ndarray, n_rows: int) -> np.ndarray:
        """How many n-grams of each row each language's filter holds."""
        found = self.table[slots(g, 0)]
        for k in range(1, HASHES):
            found &= self.table[slots(g, k)]
        width = self.table.dtype.itemsize * 8
        out = np.zeros((len(self.languages), n_rows), np.int64)
        for i in range(len(self.languages)):
            bit = (found[:, i // width] >> found.dtype.type(i % width)) & found.dtype.type(1)
            out[i] = np.bincount(rows[bit.astype(bool)], minlength=n_rows)
        return out

    def decide(self, hits: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each row and its share of all languages' rates, after taking out false positives."""
        rate = hits / np.maximum(total, 1)
        rate = np.clip((rate - self.false_rate[:, None]) / (1 - self.false_rate[:, None]), 0, 1)
        best = rate.argmax(0)
        whole = rate.sum(0)
        return best, np.where(whole > 0, rate.max(0) / np.where(whole > 0, whole, 1), 0.0)


def build(languages: list[str], members: np.ndarray, values: np.ndarray) -> Model:
    """members[i] is the language number of n-gram values[i]."""
    width = next(w for w in (8, 16, 32, 64) if len(languages) <= w or w == 64)
    kind = np.dtype(f"uint{width}").type
    table = np.zeros((SLOTS, max(1, -(-len(languages) // width))), kind)
    fill = np.zeros(len(languages))
    for i in range(len(languages)):
        own = values[members == i]
        for k in range(HASHES):
            table[slots(own, k), i // width] |= kind(1 << (i % width))
        fill[i] = np.mean((table[:, i // width] >> kind(i % width)) & kind(1))
    return Model(languages, table, fill**HASHES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = batch.column("lang").to_pylist()
        data, offsets = utf8(batch.column("text"))
        names = sorted(set(lang))
        number = np.array([names.index(x) for x in lang], np.uint64)
        for rows, g in blocks(data, offsets):
            if len(g):
                key, count = np.unique((number[rows] << np.uint64(32)) | g, return_counts=True)
                own = pa.array([names[i] for i in (key >> np.uint64(32)).tolist()])
                yield pa.RecordBatch.from_arrays([own, pa.array((key & np.uint64(2**32 - 1)).astype(np.int64)), pa.array(count.astype(np.int64))], names=["lang", "gram", "n"])


def learn(docs: DataFrame, sample: int = SAMPLE, most: int = GRAMS) -> Model:
    """Filters from labelled rows (text and lang not null).

    The fit is bounded: about `sample` documents of each language, picked by a hash of doc_id, and at most
    `most` n-grams of each language come to the driver. Whole texts are counted.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    share = rows.groupBy("lang").count().select("lang", (F.lit(float(sample)) / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64(F.lit("lang-sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(small_side(share), "lang").where(draw < F.col("share")).select("text", "lang")
    counts = picked.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    of_lang, of_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    top = (
        counts.withColumn("rate", F.col("n") / F.sum("n").over(of_lang))
        .withColumn("highest", F.max("rate").over(of_gram))
        .where((F.col("n") >= LEAST) & (F.col("rate") >= RATIO * F.col("highest")))
        .withColumn("place", F.row_number().over(of_lang.orderBy(F.col("n").desc(), "gram")))
        .where(F.col("place") <= most)
        .select("lang", "gram")
        .toPandas()
    )
    languages = sorted(top["lang"].unique())
    number = {x: i for i, x in enumerate(languages)}
    return build(languages, top["lang"].map(number).to_numpy(np.int64), top["gram"].to_numpy(np.int64).astype(np.uint32))


def lettered() -> F.Column:
    """True for rows whose text has a letter; never null."""
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the columns `pred` and `score` to every row of `docs`; whole texts are looked up, and only texts go to Python.

    `und` with score 0 if the text is null or has no letter, or if nothing was learned; a text with letters but
    no n-gram of any language gets the first learned language with score 0. An empty table gives no rows; a
    column of `docs` that is called `pred` or `score` is replaced, all others stay, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_batch(texts: pa.Array, known: pa.Array) -> pa.Array:
        m, n = shared.value, len(texts)
        preds, scores = [UNKNOWN] * n, np.zeros(n)
        if m.languages:
            data, offsets = utf8(texts)
            hits, total = np.zeros((len(m.languages), n), np.int64), np.zeros(n, np.int64)
            for rows, g in blocks(data, offsets):
                if len(g):
                    first, last = rows[0], rows[-1] + 1
                    hits[:, first:last] += m.hits(rows - first, g, last - first)
                    total[first:last] += np.bincount(rows - first, minlength=last - first)
            best, share = m.decide(hits, total)
            lettered = np.array(known.to_pylist(), bool)
            preds = [m.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), lettered.tolist(), strict=True)]
            scores = np.where(lettered, share, 0.0)
        return pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["pred", "score"])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, known in batches:
            yield of_batch(texts, known)

    found = fresh(docs, "found")
    rows = docs.withColumn(found, F.arrow_udf(run, "pred string, score double", F.ArrowUDFType.SCALAR_ITER)(F.col("text"), lettered()))
    own = own_columns(docs, (pred, score))
    return rows.select(*own, F.col(f"{found}.pred").alias(pred), F.col(f"{found}.score").alias(score))


def held_out() -> F.Column:
    """True for rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def languages(docs: DataFrame, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Learn from the rows that aren't held out and predict every row; adds two columns."""
    return predict(docs, learn(docs.where(~held_out())), pred, score)


def drop_unknown(docs: DataFrame) -> DataFrame:
    """`docs` with all its columns, without the rows that are predicted `und`: text null or without a letter.

    Where no language could be learned, the letter test alone decides, so no other row goes. An empty table gives no rows.
    """
    model, pred, score = learn(docs.where(~held_out())), fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    known = F.col(pred) != UNKNOWN if model.languages else lettered()
    return predict(docs, model, pred, score).where(known).select(*own_columns(docs))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that aren't held out; null, empty and unknown texts as in predict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lang = learn(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), lang).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
