"""Token-id files: raw id payloads in key order, and a minimal perfect hash index with stored fingerprints.

A shard is two files. `.ids` holds the ids of its documents one after the other, little-endian, 2 bytes each for
vocabularies under 65,536 ids, else 4. `.idx` maps a key to its document's place in constant time: a minimal perfect
hash gives each key a slot of its own, the slot's fingerprint tells foreign keys apart, and its start and length
locate the ids. Shards cover ascending ranges of doc_id.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _files
from ._bytes import mix
from ._common import bounded_batches, shuffle_partitions, work_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Parts of words whose ids a worker remembers; then it starts afresh.
REMEMBERED = 1_000_000
#: Bytes of text whose words are looked up together.
RUN = 1 << 23
#: Ids in a batch that is handed on.
BATCH = 1 << 20
#: Bits of a level for each key it has to place.
GAMMA = 2
LEVELS = 48
_NULL, _AGAIN, _MARK = np.uint64(0x5851F42D4C957F2D), np.uint64(0xDA3E39CB94B95BDB), np.uint64(0xB5026F5AA96619E9)


# --- encoding

# Fixed values of the tokenizer: how it normalises and splits. Only with these are texts taken apart into words here.
NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRE_TOKENIZER = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Latin letters that are their own composed form, or ASCII marks without the apostrophe (which may begin a contraction).
_ONE = r"^(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+)$"
_LETTER, _SIGN, _TAIL = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_TAIL[[*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = True  # second bytes of such letters; the first is 0xC3
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def segments(text: bytes, size: int) -> Iterator[bytes]:
    """Cuts a text before the first ASCII white space behind every `size` bytes."""
    at = 0
    while len(text) - at > size:
        found = _GAP.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class WordEncoder:
    """Encodes whole texts with the tokenizers library, each distinct word once.

    A tokenizer with the normaliser and splitter above drops white space, no token runs over it, and its normalisation
    changes nothing across it, so a text's ids are those of its words in turn. It also splits between a letter and a
    mark, so what is learned are mostly letters or marks alone. Any other tokenizer encodes every text as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        chain = json.loads(self.tokenizer.to_str())
        suffix = chain["model"].get("end_of_word_suffix")
        self.by_words = bool(suffix) and (chain["normalizer"] or {}).get("normalizers") == NORMALIZER and (chain["pre_tokenizer"] or {}).get("pretokenizers") == PRE_TOKENIZER
        self.final = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.final[[i for x, i in self.tokenizer.get_vocab(False).items() if suffix and x.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        """Known parts and their ids as raw bytes of self.width each; the empty part has none."""
        self.words, self.ids = pa.array([""], pa.string()), pa.array([b""], pa.binary())

    def _raw(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _cut(self, ids: list[int], ends: np.ndarray) -> pa.BinaryArray:
        """The ids as raw bytes, cut at the places `ends`."""
        offsets = np.concatenate(([0], ends * self.width)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(self._raw(ids))])

    def learn(self, new: pa.StringArray) -> None:
        """Encodes new parts with the library, 20,000 at a time, and remembers them."""
        one = pc.match_substring_regex(new, _ONE)
        for some, take in ((new.filter(one), self._letters_or_marks), (new.filter(pc.invert(one)), self._others)):
            for at in range(0, len(some), 20_000):
                part = some.slice(at, 20_000)
                self.ids = pa.concat_arrays([self.ids, take([w.decode("utf-8", "replace") for w in part.view(pa.binary()).to_pylist()])])
                self.words = pa.concat_arrays([self.words, part])

    def _letters_or_marks(self, words: list[str]) -> pa.BinaryArray:
        """The ids of words that are one piece to the splitter: the last id of each, and no other, ends a word."""
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            raise ValueError("the tokenizer splits Latin letters or marks in another way")
        return self._cut(ids, ends)

    def _others(self, words: list[str]) -> pa.BinaryArray:
        """The ids of any words; the offset of each id tells its word."""
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        found = self.tokenizer.encode_batch([" ".join(words)], add_special_tokens=False)[0]
        place = np.array([a for a, _ in found.offsets], np.int64)
        return self._cut(found.ids, np.searchsorted(place, starts[1:]))

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text as raw bytes of self.width each."""
        if not self.by_words:
            for text in texts:
                yield self._raw(self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids)
            return
        run, size, begun = [], 0, []
        for text in texts:
            # ASCII capitals may go first unless a mark that composes with them, or a special token, could be there
            plain = b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text
            *some, last = segments(text.lower() if plain else text, RUN)
            for part, ends in [*((x, False) for x in some), (last, True)]:
                run.append((part, ends))
                size += len(part)
                if size > RUN:
                    yield from self._ended(run, begun)
                    run, size = [], 0
        yield from self._ended(run, begun)

    def _ended(self, run: list[tuple[bytes, bool]], begun: list[bytes]) -> Iterator[bytes]:
        """The ids of the texts that end in a run of segments; `begun` holds those of the text that goes on."""
        for (_, ends), ids in zip(run, self._run([part for part, _ in run]), strict=True):
            begun.append(ids)
            if ends:
                yield b"".join(begun)
                begun.clear()

    def _run(self, parts: list[bytes]) -> list[bytes]:
        words = pc.ascii_split_whitespace(spread(parts))
        seen = words.flatten().dictionary_encode()
        distinct = seen.dictionary
        new = distinct.filter(pc.is_null(pc.index_in(distinct, self.words)))
        if len(self.words) + len(new) > REMEMBERED:
            self._forget()
            new = distinct.filter(pc.is_null(pc.index_in(distinct, self.words)))
        self.learn(new)
        ids = self.ids.take(pc.index_in(distinct, self.words)).take(seen.indices)
        return pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids), b"").to_pylist()


def spread(texts: list[bytes]) -> pa.StringArray:
    """The texts with a space between each Latin letter and a mark behind it, save those that may hold a special token."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    letter = _LETTER[data]
    letter[1:] |= _TAIL[data[1:]] & (data[:-1] == 0xC3)
    places = np.flatnonzero(letter[:-1] & _SIGN[data[1:]]) + 1
    plain = np.array([b"<|" not in t for t in texts], bool)
    places = places[plain[np.searchsorted(offsets, places, "right") - 1]] if len(places) else places
    out = np.full(len(data) + len(places), 32, np.uint8)
    out[np.arange(len(data)) + np.cumsum(np.bincount(places, minlength=len(data) + 1)[: len(data)])] = data
    moved = (offsets + np.searchsorted(places, offsets, "left")).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(moved), pa.py_buffer(out)])


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# --- index


def key_hashes(ids: np.ndarray, missing: np.ndarray, again: np.ndarray) -> np.ndarray:
    """64-bit hashes of keys: doc_id (or none), and how many rows before it in the shard have the same one."""
    with np.errstate(over="ignore"):
        return mix(mix(ids.astype(np.int64).view(np.uint64)) + missing.astype(np.uint64) * _NULL + again.astype(np.uint64) * _AGAIN)


@dataclass
class PerfectHash:
    """Levels of bits: a key's slot is the rank of its bit in the first level where its bit is set."""

    sizes: list[int]
    words: np.ndarray
    rest: np.ndarray

    def __post_init__(self):
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))

    @staticmethod
    def build(hashes: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], hashes
        for level in range(LEVELS):
            if not len(left):
                break
            size = -(-max(64, GAMMA * len(left)) // 64) * 64
            place = PerfectHash._place(left, level, size)
            count = np.bincount(place, minlength=size)
            bits = count == 1
            sizes.append(size)
            parts.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[count[place] > 1]
        return PerfectHash(sizes, np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.sort(left))

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(hashes + np.uint64(level + 1) * _MARK) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key; of a foreign key any slot, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        todo, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            place = self._place(hashes[todo], level, size) + base
            word = self.words[place >> 6]
            bit = np.uint64(1) << (place & 63).astype(np.uint64)
            hit = (word & bit) != 0
            with np.errstate(over="ignore"):
                below = np.bitwise_count(word & (bit - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (self.ranks[place >> 6] + below)[hit]
            todo, base = todo[~hit], base + size
        if len(self.rest) and len(todo):
            at = np.searchsorted(self.rest, hashes[todo])
            hit = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == hashes[todo])
            out[todo[hit]] = self.ranks[-1] + at[hit]
        return out


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ _MARK) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Index:
    hash: PerfectHash
    prints: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    #: The keys in document order: doc_id, whether it is null, and rows before with the same one.
    keys: np.ndarray
    missing: np.ndarray
    again: np.ndarray

    @staticmethod
    def build(keys: np.ndarray, missing: np.ndarray, again: np.ndarray, lengths: np.ndarray) -> Index:
        h = key_hashes(keys, missing, again)
        found = PerfectHash.build(h)
        slot = found.slots(h)
        by_slot = lambda values: values[np.argsort(slot, kind="stable")]
        starts = np.cumsum(lengths) - lengths
        return Index(found, by_slot(fingerprints(h)), by_slot(starts), by_slot(lengths), keys, missing, again)

    def find(self, ids: np.ndarray, missing: np.ndarray | None = None, again: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, start, length) of each key, in constant time a key; a foreign key is found once in 2**32 cases."""
        none = np.zeros(len(ids), np.int64)
        h = key_hashes(ids, none if missing is None else missing, none if again is None else again)
        slot = self.hash.slots(h)
        if not len(self.prints):
            return np.zeros(len(ids), bool), none, none
        known = (slot >= 0) & (self.prints[slot] == fingerprints(h))
        return known, self.starts[slot], self.lengths[slot]

    _FIELDS = (("words", "<u8"), ("rest", "<u8"), ("prints", "<u4"), ("starts", "<i8"), ("lengths", "<i8"), ("keys", "<i8"), ("missing", "<u1"), ("again", "<i4"))

    def write(self, out) -> None:
        arrays = {"words": self.hash.words, "rest": self.hash.rest} | {k: getattr(self, k) for k, _ in self._FIELDS[2:]}
        head = json.dumps({"sizes": self.hash.sizes, "lengths": {k: len(arrays[k]) for k, _ in self._FIELDS}}).encode()
        out.write(len(head).to_bytes(8, "little") + head)
        for k, kind in self._FIELDS:
            out.write(np.ascontiguousarray(arrays[k], kind).tobytes())

    @staticmethod
    def read(source) -> Index:
        data = memoryview(source.read())
        n = int.from_bytes(data[:8], "little")
        head, at, a = json.loads(bytes(data[8 : 8 + n])), 8 + n, {}
        for k, kind in Index._FIELDS:
            a[k] = np.frombuffer(data, kind, head["lengths"][k], at)
            at += a[k].nbytes
        found = PerfectHash(head["sizes"], a.pop("words"), a.pop("rest"))
        return Index(found, **a)


# --- shards

_SHARD = "shard int, ids string, idx string, width int, n_docs long, n_tokens long, first_id long, last_id long"


def _write_shard(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = end_id.to_bytes(enc.width, "little")
        out, keys, missing, lengths = None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                name = _files.new_name(folder, "")
                out = _files.writer(name + ".ids")
            ids = batch.column("doc_id")
            missing.append(np.asarray(ids.is_null()))
            keys.append(np.asarray(ids.fill_null(0)))
            texts = (t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist())
            for raw in enc.encode(texts):
                out.write(raw + end)
                lengths.append(len(raw) // enc.width + 1)
        if out is None:
            return
        out.close()
        keys, missing, lengths = np.concatenate(keys), np.concatenate(missing), np.array(lengths, np.int64)
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (missing[1:] != missing[:-1])))
        place = np.arange(len(keys))
        again = place - np.maximum.accumulate(np.where(new, place, 0))
        with _files.writer(name + ".idx") as idx:
            Index.build(keys, missing, again, lengths).write(idx)
        known = keys[~missing]
        row = [TaskContext.get().partitionId(), name + ".ids", name + ".idx", enc.width, len(keys), int(lengths.sum()), int(known[0]) if len(known) else None, int(known[-1]) if len(known) else None]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in _SHARD.split(", ")])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encodes every whole text (null: empty), appends `end_id`, and writes shards in ascending doc_id order.

    Returns the manifest, one row a shard: shard, the two files' names, width, n_docs, n_tokens, first_id, last_id,
    and base, the number of ids in all shards before. Rows are range-partitioned by doc_id (nulls first, rows that
    repeat an id next to each other) and encoded by the task that writes them. An empty table gives no shards.
    """
    import public_tokenizers

    spark = docs.sparkSession
    bounded_batches(spark)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    key = F.col("doc_id").asc_nulls_first()
    placed = rows.repartitionByRange(shuffle_partitions(spark), key).sortWithinPartitions(key, F.xxhash64("text"))
    shards = sorted(placed.mapInArrow(_write_shard(folder, path, end_id), _SHARD).collect(), key=lambda r: r["shard"])  # a row a shard
    base, out = 0, []
    for r in shards:
        out.append((*r, base))
        base += r["n_tokens"]
    return spark.createDataFrame(out, _SHARD + ", base long")


def read_tokens(manifest: DataFrame, n_shards: int | None = None) -> DataFrame:
    """doc_id, shard, start, n_tokens, ids (little-endian unsigned 32-bit numbers) of all documents in the shards' files.

    Each document is found by its key through the shard's index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                with _files.reader(s["idx"]) as source:
                    index = Index.read(source)
                with _files.reader(s["ids"]) as source:
                    at = 0
                    while at < len(index.keys):
                        to = min(len(index.keys), at + 2048)
                        pick = slice(at, to)
                        known, starts, lengths = index.find(index.keys[pick], index.missing[pick], index.again[pick])
                        if not known.all():
                            raise ValueError(f"{s['idx']}: a key isn't in its own index")
                        n = max(1, int(np.searchsorted(np.cumsum(lengths), BATCH, "right")))
                        starts, lengths = starts[:n], lengths[:n]
                        ids = [
                            np.frombuffer(source.read_at(int(c) * s["width"], int(a) * s["width"]), f"<u{s['width']}").astype("<u4").tobytes()
                            for a, c in zip(starts, lengths, strict=True)
                        ]
                        doc = pa.array(index.keys[at : at + n].astype(np.int64), mask=index.missing[at : at + n].astype(bool))
                        shard = pa.array(np.full(n, s["shard"], np.int32))
                        yield pa.RecordBatch.from_arrays([doc, shard, pa.array(starts + s["base"]), pa.array(lengths), pa.array(ids, pa.binary())], names=["doc_id", "shard", "start", "n_tokens", "ids"])
                        at += n

    rows = manifest.repartition(n_shards or max(1, manifest.count()), "shard")
    return rows.mapInArrow(run, "doc_id long, shard int, start long, n_tokens long, ids binary")


class TokenStore:
    """Keyed access: the ids of one document, by the manifest's ranges (halved), the shard's index and one read."""

    def __init__(self, manifest: DataFrame):
        rows = manifest.where("last_id is not null").orderBy("shard").collect()  # a row a shard
        self.shards, self.ends = rows, [s["last_id"] for s in rows]
        self._open = lru_cache(64)(self._load)

    @staticmethod
    def _load(name: str) -> Index:
        with _files.reader(name) as source:
            return Index.read(source)

    def get(self, doc_id: int, again: int = 0) -> np.ndarray | None:
        """The ids of the document, or of the row `again` places after the first that has its doc_id; else None.

        Rows of one doc_id stand in one shard: the first whose last_id isn't below it.
        """
        at = bisect_left(self.ends, doc_id)
        if at == len(self.shards) or self.shards[at]["first_id"] > doc_id:
            return None
        s = self.shards[at]
        known, start, n = self._open(s["idx"]).find(np.array([doc_id]), again=np.array([again]))
        if not known[0]:
            return None
        with _files.reader(s["ids"]) as source:
            return np.frombuffer(source.read_at(int(n[0]) * s["width"], int(start[0]) * s["width"]), f"<u{s['width']}")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to files and read back from them."""
    manifest = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), work_dir(spark, "tokens"))
    return read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
