"""Spelling variants: every word's full neighbourhood of one edit over the observed alphabet, joined with the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import mix
from ._common import bounded_batches, discard, materialize, shuffle_partitions

#: Words have so many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form occurs so many times as often at least.
RATIO = 5
#: A run loses a code point where this divides the CRC-32 of its document's id and itself.
TYPO = 199
#: Texts longer than this many bytes are searched without a list of all their runs.
LONG = 1 << 20
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 17
#: Words of the vocabulary in a task that generates neighbours.
PER_TASK = 10_000
#: The filter has BITS bits a word at least and MOST_BITS in all; a larger vocabulary is taken in slices of SLICE words.
BITS, MOST_BITS, SLICE, PROBES = 16, 1 << 26, 1 << 22, 3
#: Candidates worked on at a time.
_STEP = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


# --- the vocabulary


def _runs(least: int, typo: int | None):
    pattern = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                # all letters of a run are below U+0100, so what Latin-1 lacks only separates runs
                latin = (text.as_py() or b"").decode("utf-8", "replace").encode("latin-1", "replace").lower()
                found = pattern.findall(latin) if len(latin) <= LONG else (m.group() for m in pattern.finditer(latin))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(found).items():
                    if typo:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                        if h % typo == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    held[word] += n
                if len(held) > HELD:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typo: int | None = TYPO) -> DataFrame:
    """(word, n): maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z in lower case, that are long and frequent enough.

    With `typo`, a run whose document's id and itself have a CRC-32 that `typo` divides loses one code point first. Null texts have no runs; a
    null doc_id counts as empty; rows that repeat a doc_id count each. Words are counted in the tasks before they are shuffled, so a
    frequent word is a few rows. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(_runs(least_length, typo), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# --- neighbourhoods


def values(points: np.ndarray) -> np.ndarray:
    """A random-looking 64-bit number for each code point."""
    with np.errstate(over="ignore"):
        return mix(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _finish(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + np.uint64(length) * np.uint64(0xD6E8FEB86659FD93))


def _prefixes(words: np.ndarray) -> np.ndarray:
    """[row, i]: the polynomial hash of the first i code points of each word of a matrix."""
    n, length = words.shape
    out = np.zeros((n, length + 1), np.uint64)
    np.add.accumulate(values(words) * _powers(length), axis=1, out=out[:, 1:])
    return out


def hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the words of a matrix of code points."""
    return _finish(_prefixes(words)[:, -1], words.shape[1])


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of code points) of the words of each length that occurs; words aren't empty."""
    texts = column.to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield rows, np.array([texts[i] for i in rows.tolist()], f"<U{length}").view("<u4").reshape(len(rows), length)


def neighbours(words: np.ndarray, alphabet: np.ndarray, holds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of code points): of all distinct strings one deletion, replacement or insertion away from each word, those that `holds` takes.

    Every string is met once: a run of equal letters loses its last one, no letter is replaced by itself, and none is inserted behind its like.
    `holds` gets 64-bit hashes, made by shifting the hashes of the parts before and behind the edit, so that only strings it takes are spelled out.
    """
    n, length = words.shape
    power, letter = _powers(length + 1), values(alphabet)
    step = max(1, _STEP // ((length + 1) * len(alphabet)))
    for first in range(0, n, step):
        part = words[first : first + step]
        before = _prefixes(part)
        whole = before[:, -1:]
        # deletions
        total = before[:, :-1] + (whole - before[:, 1:]) * _INVERSE
        new = np.ones(part.shape, bool)
        new[:, :-1] = part[:, 1:] != part[:, :-1]
        row, at = np.nonzero(new)
        keep = holds(_finish(total[row, at], length - 1))
        row, at = row[keep], at[keep]
        if len(row):
            place = np.arange(length - 1)
            yield first + row, part[row[:, None], place + (place >= at[:, None])]
        # replacements
        total = (whole + (np.zeros(1, np.uint64) - values(part)) * power[:length])[:, :, None] + power[:length, None] * letter
        row, at, to = np.nonzero(holds(_finish(total.ravel(), length)).reshape(total.shape) & (part[:, :, None] != alphabet))
        if len(row):
            out = part[row]
            out[np.arange(len(row)), at] = alphabet[to]
            yield first + row, out
        # insertions
        total = (before + (whole - before) * _BASE)[:, :, None] + power[:, None] * letter
        new = np.ones(total.shape, bool)
        new[:, 1:] = part[:, :, None] != alphabet
        row, at, to = np.nonzero(holds(_finish(total.ravel(), length + 1)).reshape(total.shape) & new)
        if len(row):
            place = np.arange(length + 1)
            out = part[row[:, None], np.clip(place - (place > at[:, None]), 0, length - 1)]
            out[np.arange(len(row)), at] = alphabet[to]
            yield first + row, out


# --- a filter of the vocabulary


def _slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of a hash in the filter; `bits` is a power of two."""
    return [(h >> np.uint64(19 * i)) & np.uint64(bits - 1) for i in range(PROBES)]


def _slice(h: np.ndarray, slices: int) -> np.ndarray:
    return mix(h) % np.uint64(slices)


def _filter_rows(bits: int, own: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                with np.errstate(over="ignore"):
                    h = np.concatenate([hashes(words) for _, words in by_length(batch.column("word"))])
                    h = h[_slice(h, slices) == own]
                place = np.unique(np.concatenate(_slots(h, bits)))
                one = np.uint64(1) << (place & np.uint64(63))
                yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(one.view(np.int64))], names=["slot", "bits"])

    return run


def _filter(words: DataFrame, bits: int, own: int, slices: int) -> np.ndarray:
    """A Bloom filter of one slice of the vocabulary, as 64-bit words; the OR is taken by Spark, at most MOST_BITS come to the driver."""
    rows = words.select("word").mapInArrow(_filter_rows(bits, own, slices), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    found = rows.toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[found["slot"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _candidates(shared, alphabet: np.ndarray, own: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        bits = len(table) * 64

        def holds(h: np.ndarray) -> np.ndarray:
            left = np.arange(len(h))
            for probe in range(PROBES):  # most are out after the first look
                place = (h[left] >> np.uint64(19 * probe)) & np.uint64(bits - 1)
                left = left[(table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
            if slices > 1:
                left = left[_slice(h[left], slices) == own]
            out = np.zeros(len(h), bool)
            out[left] = True
            return out

        for batch in batches:
            for rows, words in by_length(batch.column("word")):
                with np.errstate(over="ignore"):
                    for row, found in neighbours(words, alphabet, holds):
                        texts = np.ascontiguousarray(found, "<u4").view(f"<U{found.shape[1]}").ravel() if found.shape[1] else np.full(len(row), "")
                        yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(rows[row])), pa.array(texts.tolist(), pa.string())], names=["word", "near"])

    return run


def near_pairs(words: DataFrame, n_words: int) -> DataFrame:
    """(word, near, near_n): all ordered pairs of the vocabulary `words` (word, n) that one edit of one code point turns into each other.

    Every word's whole neighbourhood is generated. A candidate first looks into a Bloom filter of the vocabulary, which
    lets all words through and few others, and what is left is joined with the vocabulary by the string itself; no distance is computed.
    A filter has a bounded size: a vocabulary of more than SLICE words is taken in slices, each with a filter of its own.
    """
    spark = words.sparkSession
    alphabet = np.array(sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0]), np.uint32)  # one row a code point
    slices = max(1, -(-n_words // SLICE))
    bits = 1 << max(12, min(MOST_BITS.bit_length() - 1, (BITS * -(-n_words // slices) - 1).bit_length()))
    spread = words.select("word").repartition(max(shuffle_partitions(spark), -(-n_words // PER_TASK)), "word")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    out = []
    for own in range(slices):
        shared = spark.sparkContext.broadcast(_filter(words, bits, own, slices))
        out.append(spread.mapInArrow(_candidates(shared, alphabet, own, slices), "word string, near string").join(known, "near"))
    return reduce(DataFrame.unionByName, out)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of `forms` (word, form), whose forms end: each round doubles the way that is behind a pointer."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "pointers")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        after = materialize(now.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "pointers")
        discard(now)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")
        now.written_to = after.written_to


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n): distinct words that aren't empty.

    Two words are near if one inserted, deleted or replaced code point turns one into the other. A word's form is its near word
    of largest n (ties: the smallest in code point order) if that has `ratio` times its n at least; else null, as is form_n. root follows forms to the last one.
    An empty vocabulary gives no rows. As `ratio` is over 1, no chain of forms comes back.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    words = materialize(words, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    met = near_pairs(words, words.count()).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    own = F.when(most >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), most.alias("form_n")))
    named = words.join(met, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), own.alias("own"))
    named = materialize(named.select("word", "n", "n_near", "own.form", "own.form_n"), "forms")
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents; null and empty texts and repeated rows as in `vocabulary`, ties as in `variants`."""
    return variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))


ORACLE = rf"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]{{{LEAST_LENGTH},}}')) AS run FROM documents
), own AS (
  SELECT doc_id, run, count(*) AS k FROM runs GROUP BY doc_id, run
), crc AS (
  SELECT run, k, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
        lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS h
  FROM own, crc_table
), typed AS (
  SELECT CASE WHEN h % {TYPO} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM crc
), v AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM typed WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}
), cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM v)
), near AS MATERIALIZED (
  SELECT cut.word AS a, v.word AS b FROM cut JOIN v ON v.word = cut.rest
  UNION SELECT v.word, cut.word FROM cut JOIN v ON v.word = cut.rest
  UNION SELECT x.word, y.word FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
), ranked AS (
  SELECT a, b, n AS bn, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS place FROM near JOIN v ON v.word = b
), forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN bn >= {RATIO} * n THEN b END AS form, CASE WHEN bn >= {RATIO} * n THEN bn END AS form_n
  FROM v LEFT JOIN ranked ON a = word AND place = 1
), walk(word, place) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.place WHERE forms.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.place AS root FROM walk JOIN forms ON forms.word = walk.place WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
