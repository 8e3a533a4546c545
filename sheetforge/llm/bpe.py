"""Byte-level BPE encoding and decoding with a local rank file, through the tiktoken library."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StructField, StructType

from ._common import map_arrow, own_columns

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Longer texts are encoded in pieces of about so many characters.
PIECE = 1 << 16
#: Bytes of a batch that is handed on; bounds the memory beside one row.
BATCH = 1 << 22


@lru_cache(4)
def encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cuts a text where a space or line feed follows a character that isn't white space.

    No match of the splitting pattern runs over such a place: a match holds white space only as its first
    character or throughout, and none looks ahead past a character that isn't white space. So the pieces'
    matches are the text's. Without such a place the text stays whole.
    """
    at, n = 0, len(text)
    while n - at > size:
        cut = at + size
        while cut > at and not (text[cut] in " \n" and not text[cut - 1].isspace()):
            cut -= 1
        if cut == at:
            cut = at + size
            while cut < n and not (text[cut] in " \n" and not text[cut - 1].isspace()):
                cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode(text: str, enc) -> array:
    if len(text) <= PIECE:
        return array("I", enc.encode_ordinary(text))
    ids = array("I")
    for piece in pieces(text):
        ids.extend(enc.encode_ordinary(piece))
    return ids


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about BATCH bytes."""
    for batch in batches:
        rows = max(1, batch.num_rows * BATCH // max(BATCH, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _replaced(batch: pa.RecordBatch, column: str, values: list[bytes]) -> pa.RecordBatch:
    i = batch.schema.names.index(column)
    return batch.set_column(i, pa.field(column, pa.binary()), pa.array(values, pa.binary()))


def _map(rows: DataFrame, column: str, to: str, make) -> DataFrame:
    """Rewrites one column with `make(list of values) -> list of bytes` as the binary column `to`, in place of any that is called so."""

    def run(batches):
        for batch in _batches(batches, column):
            yield _replaced(batch, column, make(batch.column(column).to_pylist()))

    rows = rows.select(*own_columns(rows, (to,) if to != column else ()))
    schema = StructType([StructField(to, BinaryType()) if f.name == column else f for f in rows.schema])
    return map_arrow(rows, run, schema)


def encode_documents(rows: DataFrame, ranks: str, pattern: str, column: str = "text") -> DataFrame:
    """Replaces the text `column` by `ids`: its token ids as little-endian unsigned 32-bit numbers.

    Every whole text is encoded as tiktoken's encode_ordinary does, without special tokens. A null text is an
    empty one and gives no ids; other columns stay, whatever their names, but for one that is called ids. Ids are numbers under 2**32 in the order of the text.
    """

    def make(texts):
        enc = encoding(ranks, pattern)
        return [encode(t or "", enc).tobytes() for t in texts]

    return _map(rows, column, "ids", make)


def decode_documents(rows: DataFrame, ranks: str, pattern: str, column: str = "ids") -> DataFrame:
    """Replaces the binary `column` of ids by `decoded`: the raw bytes they stand for, which need not be valid UTF-8."""

    def make(values):
        enc = encoding(ranks, pattern)
        return [enc.decode_bytes(array("I", v or b"").tolist()) for v in values]

    return _map(rows, column, "decoded", make)


def round_trip(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; the tokens are decoded again from the ids.

    One worker does both, piece by piece, so a task needs one worker only and memory holds one piece's ids.
    """
    import public_tokenizers

    ranks, pattern = ranks or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string")])

    def digests(text: str, enc) -> tuple[int, str, str]:
        n, ids_sha, decoded_sha = 0, hashlib.sha256(), hashlib.sha256()
        for piece in pieces(text):
            ids = enc.encode_ordinary(piece)
            n += len(ids)
            ids_sha.update(array("I", ids))
            decoded_sha.update(enc.decode_bytes(ids))
        return n, ids_sha.hexdigest(), decoded_sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            found = [digests(t.as_py() or "", enc) for t in batch.column("text")]
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=schema.names)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again; a null or empty text has no tokens, rows that repeat give the same row."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
