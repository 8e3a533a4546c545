"""Near-duplicates: MinHash signatures, a multi-index Hamming join, and exact confirmation on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import mix, shingle_hashes, utf8, word_hashes
from ._common import bounded_batches, copied, dealt, discard, hot_values, materialize, own_columns, small_side
from .components import connected_components

WIDTH = 5
#: Links need 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: A signature has CHUNKS chunks of PER_CHUNK symbols of BITS bits; a chunk is one 60-bit number.
CHUNKS, PER_CHUNK, BITS = 16, 4, 14
#: Errors that may be in a chunk. If two signatures differ in DISTANCE symbols at most, then some chunk of them
#: has ERRORS at most, by the pigeonhole principle; all such pairs are found.
ERRORS = 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Buckets that aren't settled by their smallest member are compared in blocks of about so many members.
PER_BLOCK = 1024
#: Bits of a set's parity sketch, 64 a word. Bit i is the parity of the number of shingle hashes whose top bits are i, so
#: two sketches differ in no more bits than their sets do in shingles: a bound that loses no link.
SKETCH = 1024
#: Buckets with more than so many pairs of members for each of their members are first settled by members picked by a hash, in so many rounds at most.
CROWD, ROUNDS = 32, 2
_WORDS = SKETCH // 64

_LANE = [s * (BITS + 1) for s in range(PER_CHUNK)]
_FULL = sum(((1 << BITS) - 1) << s for s in _LANE)
_CARRY = sum(1 << (s + BITS) for s in _LANE)
_rng = np.random.Generator(np.random.PCG64(77))
_N = CHUNKS * PER_CHUNK
_A = _rng.integers(0, 2**64, _N, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**64, _N, dtype=np.uint64)
_SET = _rng.integers(0, 2**64, 2, dtype=np.uint64)
#: Shingles hashed at a time.
_STEP = 1 << 15


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for each row of the column text."""
    data, offsets = utf8(batch.column("text"))
    for first, last, words, bounds in word_hashes(data, offsets):
        for row in range(first, last):
            yield row, np.unique(shingle_hashes(words[bounds[row - first] : bounds[row - first + 1]], width))


def _signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """The packed signatures of some non-empty sets, one row each."""
    if len(sets) == 1 and len(sets[0]) > _STEP:  # a very long text: in pieces
        pieces = [sets[0][i : i + _STEP] for i in range(0, len(sets[0]), _STEP)]
        least = np.min([[(p * a + b).min() for a, b in zip(_A, _B, strict=True)] for p in pieces], axis=0)[:, None]
    else:
        values, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
        least = np.empty((_N, len(sets)), np.uint64)
        for j in range(_N):
            least[j] = np.minimum.reduceat(values * _A[j] + _B[j], starts)
    symbols = (mix(least) >> np.uint64(64 - BITS)).reshape(CHUNKS, PER_CHUNK, -1)
    packed = np.zeros((CHUNKS, symbols.shape[2]), np.uint64)
    for s, lane in enumerate(_LANE):
        packed |= symbols[:, s] << np.uint64(lane)
    return packed.T.astype(np.int64)


def _sketch(found: np.ndarray) -> np.ndarray:
    """The parity sketch of one set of shingle hashes, as 64-bit words."""
    odd = np.bincount((found >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _lists(values: np.ndarray) -> pa.ListArray:
    """A list a row of a matrix."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, np.int32)), pa.array(values.ravel()))


def _signature_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            count, key, sig = np.zeros(n, np.int64), np.zeros((2, n), np.uint64), np.zeros((n, CHUNKS), np.int64)
            sketch = np.zeros((n, _WORDS), np.int64)
            waiting, rows, held = [], [], 0

            def flush():
                if waiting:
                    sig[rows] = _signatures_of(waiting)  # noqa: B023
                    waiting.clear()
                    rows.clear()

            with np.errstate(over="ignore"):
                for row, found in _sets(batch, width):
                    count[row] = len(found)
                    if not len(found):
                        continue
                    for k in range(2):
                        key[k, row] = mix(found ^ _SET[k]).sum(dtype=np.uint64)
                    sketch[row] = _sketch(found)
                    if held + len(found) > _STEP:
                        flush()
                        held = 0
                    waiting.append(found)
                    rows.append(row)
                    held += len(found)
                flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count), pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), _lists(sig), _lists(sketch)],
                names=["doc_id", "n_shingles", "set1", "set2", "sig", "sketch"],
            )

    return run


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows, sets, held = [], [], 0
            for row, found in _sets(batch, width):
                rows.append(row)
                sets.append(found)
                held += len(found)
                if held > 1 << 20 or row == batch.num_rows - 1:
                    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), lists], names=["doc_id", "shingles"])
                    rows, sets, held = [], [], 0

    return run


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the whole set (set1, set2), the packed signature and the parity sketch of each row."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_shingles long, set1 long, set2 long, sig array<long>, sketch array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_signature_rows(width), schema)


def _keys() -> Column:
    """(k, key) for each chunk and each symbol of it that may be wrong: a hash of the chunk without that symbol."""
    masks = [_FULL & ~(((1 << BITS) - 1) << lane) for lane in _LANE]
    return F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.xxhash64(F.lit(k), F.col("sig")[k // PER_CHUNK].bitwiseAND(F.lit(masks[k % PER_CHUNK]))).alias("key"))
            for k in range(_N)
        ]
    )


def _flat(side: str) -> list[Column]:
    """A signature's chunks and a sketch's words as columns that can't be null, so that a join's condition stays small."""
    flat = lambda column, n, mark: [F.coalesce(F.col(column)[i], F.lit(0).cast("long")).alias(f"{side}{mark}{i}") for i in range(n)]
    return flat("sig", CHUNKS, "") + flat("sketch", _WORDS, "p")


def _wrong(chunk: int) -> Column:
    """Bits of the symbols in which x and y differ: a lane that isn't zero after XOR carries into its spare bit."""
    return (F.col(f"x{chunk}").bitwiseXOR(F.col(f"y{chunk}")) + F.lit(_FULL)).bitwiseAND(F.lit(_CARRY))


def _near(threshold: int) -> Column:
    """Whether the sizes and the parity sketches of x and y allow a link, and their signatures are within DISTANCE.

    Sets of n shingles in all that are linked differ in n * (100 - threshold) / (100 + threshold) of them at most, and
    their sketches in no more bits than that.
    """
    sizes = F.least("xn", "yn") * 100 >= F.greatest("xn", "yn") * threshold
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"xp{i}").bitwiseXOR(F.col(f"yp{i}"))) for i in range(_WORDS)])
    differ = bits * (100 + threshold) <= (F.col("xn") + F.col("yn")) * (100 - threshold)
    return sizes & differ & (reduce(Column.__add__, [F.bit_count(_wrong(c)) for c in range(CHUNKS)]) <= DISTANCE)


def _meet_first() -> Column:
    """Whether the bucket of y's key k is the first that x and y share, so that a pair counts in one bucket only.

    No chunk before the key's has ERRORS or fewer (the key's own has, as they share it), and of the keys of an equal
    chunk only the first counts.
    """
    every = lambda f: reduce(Column.bitwiseOR, [F.when(f(c), F.lit(1 << c)).otherwise(F.lit(0)) for c in range(CHUNKS)])
    close = every(lambda c: F.bit_count(_wrong(c)) <= ERRORS)
    equal = every(lambda c: F.col(f"x{c}") == F.col(f"y{c}"))
    return (close.bitwiseAND(2 * F.col("bit") - 1) == F.col("bit")) & (F.col("leading") | (equal.bitwiseAND(F.col("bit")) == 0))


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough. Only the texts of paired documents are read again."""
    pairs = materialize(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    # one row an id is written once, from the ends of the pairs that are told apart before they meet
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).distinct().unionByName(pairs.select(F.col("b").alias("doc_id")).distinct()).distinct(), "ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(ids), "doc_id", "left_semi")
    sets = rows.mapInArrow(_set_rows(width), "doc_id long, shingles array<long>")
    sets = sets.groupBy("doc_id").agg(F.max("shingles").alias("s"))  # one row an id, also if rows repeat an id
    hot = {side: hot_values(pairs, side) for side in ("a", "b")}
    for side in hot:  # a document of very many pairs is copied, and its pairs are dealt over the copies
        own = copied(sets.select(F.col("doc_id").alias(side), F.col("s").alias(f"s{side}")), side, hot[side])
        pairs = dealt(pairs, side, hot[side], ["a", "b"]).join(own, [side, "copy"]).drop("copy")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - common
    return materialize(pairs.where(common * 100 >= union * threshold).select("a", "b"), "links")


def _picked(members: DataFrame, turn: int) -> DataFrame:
    """For each bucket that holds several components: a member that a hash picks anew each turn, with its component, and the bucket's size g."""
    one = F.struct(F.xxhash64(F.lit(turn), "key", "rep").alias("h"), "rep", "component")
    picks = members.groupBy("key").agg(F.min(one).alias("p"), F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("g"))
    return picks.where("least < most").select("key", F.col("p.rep").alias("other"), F.col("p.component").alias("its"), "g")


def _meetings(members: DataFrame, picked: DataFrame) -> DataFrame:
    """(x, y): each member of a bucket with the one that is picked there, unless both are of one component; so a pair a member at most, however large the bucket."""
    return members.join(picked, "key").where("component != its").select(F.least("other", "rep").alias("x"), F.greatest("other", "rep").alias("y"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z) and split at ASCII white space; a document's set holds the hashes (64 bits) of
    its distinct `width`-word shingles. Two documents are linked if 100 * intersection >= threshold * union.

    1. Rows with equal sets fold into one representative, the smallest doc_id.
    2. Each signature gives CHUNKS * PER_CHUNK keys: a chunk with one symbol left out. Pairs whose signatures
       differ in DISTANCE of the CHUNKS * PER_CHUNK symbols at most share a key (pigeonhole principle). At the
       similarity 0.75 a symbol differs with probability 0.25, so a linked pair is farther apart about once in
       69,000 cases; more similar pairs far more rarely.
    3. In each bucket all members meet the smallest one first, never each other; confirmed links make components.
       Where large buckets still hold several components, all members meet one that a hash picks, in ROUNDS rounds at most.
    4. Pairs across components in buckets that still hold several are compared too, in blocks, each pair in the first
       bucket that it shares. So no bucket is capped, and no link that could join two components is left out.
    In both, the tests of size, parity sketch and distance stand inside the join, so that pairs which can't be linked
    aren't emitted. The first two of them lose no link at all.

    Null and wordless texts have an empty set and are linked with nothing. Rows without doc_id are linked with
    nothing: component_id is null and kept true. Rows that repeat a doc_id count as one document; one row stays
    kept for each. An empty table gives no rows; other columns are ignored.
    """
    sigs = materialize(signatures(docs, width), "signatures")
    classes = materialize(
        sigs.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set1", "set2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")),
        "classes",
    )
    as_x = classes.select(F.col("rep").alias("x"), F.col("n").alias("xn"), *_flat("x"))
    as_y = classes.select(F.col("rep").alias("y"), F.col("n").alias("yn"), *_flat("y"))
    keys = classes.select("rep", F.explode(_keys()).alias("e")).select("rep", "e.k", "e.key")
    shared = materialize(keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("members")).where("members > 1"), "shared")
    stored = materialize(keys.join(shared, "key").select("key", "k", "pivot", "members", "rep"), "buckets")

    def linked(meetings: DataFrame) -> DataFrame:
        """The links among pairs (x, y)."""
        meet = materialize(meetings.distinct(), "meetings")
        hot = hot_values(meet, "x")
        near = dealt(meet, "x", hot, ["y"]).join(as_y, "y").join(copied(as_x, "x", hot), ["x", "copy"]).where(_near(threshold)).select(F.col("x").alias("a"), F.col("y").alias("b"))
        out = _confirmed(near, docs, width, threshold)
        discard(meet)
        return out

    def by_component() -> DataFrame:
        """Members of the buckets that their smallest may not have settled, with their components as they are known."""
        rows = stored.where("members > 2").join(found, F.col("rep") == F.col("vertex"), "left")
        return rows.select("key", "k", "rep", F.coalesce("component", "rep").alias("component"))

    links = linked(stored.where("rep != pivot").select(F.col("pivot").alias("x"), F.col("rep").alias("y")))
    found = connected_components(links)
    for turn in range(ROUNDS):
        picked = materialize(_picked(by_component(), turn), "picked")
        large = picked.agg(F.coalesce(F.sum(F.expr("g * g")) > CROWD * F.sum("g"), F.lit(False))).first()[0]
        more = linked(_meetings(by_component(), picked)) if large else None
        discard(picked)
        if more is None or more.isEmpty():
            break
        links = links.unionByName(more)
        found = connected_components(links)

    named = by_component()
    unsettled = materialize(
        named.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("g"))
        .where("lo < hi")
        .select("key", F.expr(f"cast((g + {PER_BLOCK - 1}) div {PER_BLOCK} as int)").alias("blocks")),
        "blocks",
    )
    rows = materialize(
        named.join(unsettled, "key")
        .join(classes.select("rep", "n", "sig", "sketch"), "rep")
        .withColumn("block", F.expr("cast(pmod(xxhash64(rep), blocks) as int)")),
        "members",
    )
    place = [F.expr(f"shiftleft(1, k div {PER_CHUNK})").alias("bit"), (F.col("k") % PER_CHUNK == 0).alias("leading")]
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    left = rows.select("key", F.col("block").alias("i"), every.alias("j"), F.col("component").alias("cx"), F.col("rep").alias("x"), F.col("n").alias("xn"), *_flat("x"))
    right = rows.select("key", *place, every.alias("i"), F.col("block").alias("j"), F.col("component").alias("cy"), F.col("rep").alias("y"), F.col("n").alias("yn"), *_flat("y"))
    across = (
        left.join(
            right,
            (left["key"] == right["key"]) & (left["i"] == right["i"]) & (left["j"] == right["j"]) & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & _near(threshold) & _meet_first(),
        )
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
        .distinct()
    )
    more = _confirmed(across, docs, width, threshold)
    discard(shared, stored, unsettled, rows)
    if not more.isEmpty():
        found = connected_components(links.unionByName(more))

    name = classes.join(found, F.col("rep") == F.col("vertex"), "left").select(
        "set1", "set2", "rep", F.coalesce("component", "rep").alias("component_id")
    )
    out = sigs.join(name, (sigs["set1"] == name["set1"]) & (sigs["set2"] == name["set2"]) & (sigs["n_shingles"] > 0) & sigs["doc_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with all its columns, without the rows that aren't the smallest doc_id of their component."""
    lost = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(small_side(materialize(lost, "lost")), "doc_id", "left_anti").select(*own_columns(docs))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates of all documents; null, empty and repeated rows as in near_duplicates."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number(array_to_string(words[i:i+4], ' ')) AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(na.n) AS na, any_value(nb.n) AS nb
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.doc_id WHERE r.root < e.b
), c AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id
"""
