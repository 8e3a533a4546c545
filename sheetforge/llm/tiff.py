"""TIFF: a writer, and a reader that walks image directories and emits one row per page.

The reader takes both byte orders, strips and tiles, no compression, PackBits, LZW and deflate, and undoes the
horizontal predictor; samples are 8 bits wide.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import bounded_batches, map_arrow, quoted

# Fixed values of the format: compression schemes and tags.
NONE, LZW, DEFLATE, DEFLATE_OLD, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, LENGTH, SAMPLE_BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PREDICTOR = 273, 277, 278, 279, 317
TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
#: Bytes of one value of each field type.
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
TYPE_CODE = {1: "B", 3: "H", 4: "I"}
#: What damage or a kind of page that isn't supported raises.
ERRORS = (ValueError, KeyError, IndexError, TypeError, ArithmeticError, struct.error, zlib.error, MemoryError)

#: Samples in a row of a page that holds a payload, and rows in a page.
COLUMNS = 64
PAGE_ROWS = 512
STRIP_ROWS = 128
TILE = 64
#: (compression, tiled, predictor) of a payload's pages in turn, from the one that its CRC-32 picks.
LAYOUTS = ((DEFLATE, False, 2), (PACKBITS, False, 1), (DEFLATE, True, 2), (LZW, False, 2))


# --- codecs


def packbits_encode(data: bytes) -> bytes:
    """Runs of three or more equal bytes as runs, all else as literals of 128 bytes at most."""
    a = np.frombuffer(data, np.uint8)
    out = bytearray()
    if not len(a):
        return b""
    edges = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]))
    starts, lengths = edges[:-1], np.diff(edges)
    long = np.flatnonzero(lengths >= 3)
    at = 0

    def literals(to):
        nonlocal at
        while at < to:
            n = min(128, to - at)
            out.append(n - 1)
            out.extend(data[at : at + n])
            at += n

    for start, n in zip(starts[long].tolist(), lengths[long].tolist(), strict=True):
        literals(start)
        while n >= 2:
            k = min(128, n)
            out.append(257 - k)
            out.append(data[start])
            n -= k
            at += k
        # a single byte left over goes to the next literals
    literals(len(a))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, at, n = bytearray(), 0, len(data)
    while at < n and len(out) < size:
        head = data[at]
        if head < 128:
            out += data[at + 1 : at + 2 + head]
            at += head + 2
        elif head > 128:
            out += data[at + 1 : at + 2] * (257 - head)
            at += 2
        else:
            at += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """MSB-first codes of 9 to 12 bits; the width grows one code early; the table is cleared when full."""
    out, bits, held = bytearray(), 0, 0

    def put(code, width):
        nonlocal bits, held
        bits, held = bits << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held & 255)
        bits &= (1 << held) - 1

    singles = {bytes([i]): i for i in range(256)}
    table, following, width = dict(singles), 258, 9
    put(256, 9)
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = following
        following += 1
        if following == 4095:
            put(256, width)
            table, following, width = dict(singles), 258, 9
        elif following + 1 > 1 << width:
            width += 1
        word = data[i : i + 1]
    if word:
        put(table[word], width)
        following += 1
        if following + 1 > 1 << width and width < 12:
            width += 1
    put(257, width)
    if held:
        out.append(bits << (8 - held) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out, bits, held, at = bytearray(), 0, 0, 0
    singles = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, last = list(singles), 9, None
    while len(out) < size:
        while held < width:
            if at >= len(data):
                return bytes(out)
            bits, held, at = (bits << 8 | data[at]) & 0xFFFFFFFF, held + 8, at + 1
        held -= width
        code = bits >> held & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = list(singles), 9, None
            continue
        if last is None:
            word = table[code]
        else:
            if code < len(table):
                word = table[code]
            elif code == len(table):
                word = last + last[:1]
            else:
                raise ValueError("LZW code out of range")
            table.append(last + word[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out += word
        last = word
    return bytes(out)


def compress(data: bytes, scheme: int) -> bytes:
    if scheme == NONE:
        return data
    if scheme == PACKBITS:
        return packbits_encode(data)
    return lzw_encode(data) if scheme == LZW else zlib.compress(data, 4)


def expand(data: bytes, scheme: int, size: int) -> bytes:
    if scheme == NONE:
        return data[:size]
    if scheme == PACKBITS:
        return packbits_decode(data, size)
    if scheme == LZW:
        return lzw_decode(data, size)
    if scheme in (DEFLATE, DEFLATE_OLD):
        return zlib.decompressobj().decompress(data, size)
    raise ValueError(f"compression {scheme} isn't supported")


# --- pages


def write_tiff(pages: list[tuple[np.ndarray, int, bool, int]]) -> bytes:
    """Little-endian, one directory per (samples, compression, tiled, predictor); samples are rows x columns (x channels)."""
    out = bytearray(struct.pack("<2sHI", b"II", 42, 0))
    link = 4
    for samples, scheme, tiled, predictor in pages:
        rows, columns = samples.shape[:2]
        depth = samples.shape[2] if samples.ndim == 3 else 1
        grid = samples.reshape(rows, columns, depth)
        if tiled:
            blocks = []
            for y in range(0, rows, TILE):
                for x in range(0, columns, TILE):
                    part = grid[y : y + TILE, x : x + TILE]
                    blocks.append(np.pad(part, ((0, TILE - part.shape[0]), (0, TILE - part.shape[1]), (0, 0)), mode="edge"))
        else:
            blocks = [grid[y : y + STRIP_ROWS] for y in range(0, rows, STRIP_ROWS)]
        places, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate((block[:, :1], block[:, 1:] - block[:, :-1]), axis=1)
            body = compress(block.tobytes(), scheme)
            places.append(len(out))
            sizes.append(len(body))
            out += body
        entries = {WIDTH: (4, [columns]), LENGTH: (4, [rows]), SAMPLE_BITS: (3, [8] * depth), COMPRESSION: (3, [scheme]), PHOTOMETRIC: (3, [2 if depth == 3 else 1]), SAMPLES: (3, [depth]), PREDICTOR: (3, [predictor])}
        if tiled:
            entries |= {TILE_WIDTH: (4, [TILE]), TILE_LENGTH: (4, [TILE]), TILE_OFFSETS: (4, places), TILE_COUNTS: (4, sizes)}
        else:
            entries |= {ROWS_PER_STRIP: (4, [STRIP_ROWS]), STRIP_OFFSETS: (4, places), STRIP_COUNTS: (4, sizes)}
        packed = {}
        for tag, (kind, values) in entries.items():
            body = struct.pack(f"<{len(values)}{TYPE_CODE[kind]}", *values)
            if len(body) > 4:
                out += b"\0" * (len(out) % 2)
                packed[tag] = (kind, len(values), struct.pack("<I", len(out)))
                out += body
            else:
                packed[tag] = (kind, len(values), body.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(packed))
        for tag in sorted(packed):
            kind, n, value = packed[tag]
            out += struct.pack("<HHI", tag, kind, n) + value
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def read_tiff(data: bytes) -> Iterator[dict]:
    """The pages of a file in order: page, width, height, channels, compression, predictor, tiled, samples (bytes).

    A page that can't be decoded is given as page and error; those behind it follow. Raises ValueError or struct.error
    where the file is none or the chain of directories breaks.
    """
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack(f"{order}H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen, page = struct.unpack(f"{order}I", data[4:8])[0], set(), 0
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("broken chain of directories")
        seen.add(at)
        here, n = at, struct.unpack_from(f"{order}H", data, at)[0]
        at = struct.unpack_from(f"{order}I", data, here + 2 + 12 * n)[0]
        try:
            found = _page(data, order, here, n)
        except ERRORS as e:
            found = {"error": f"{type(e).__name__}: {e}"}
        yield {"page": page} | found
        page += 1


def _page(data: bytes, order: str, at: int, n: int) -> dict:
    """The page whose directory of n entries is at `at`."""
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        if kind in TYPE_CODE:
            size = TYPE_SIZE[kind] * count
            place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(f"{order}I", data, at + 10 + 12 * k)[0]
            tags[tag] = struct.unpack_from(f"{order}{count}{TYPE_CODE[kind]}", data, place)
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    width, height, depth, scheme, predictor = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if set(tags.get(SAMPLE_BITS, (8,))) != {8} or predictor not in (1, 2):
        raise ValueError("only 8-bit samples with predictor 1 or 2 are supported")
    tiled = TILE_OFFSETS in tags
    tall, wide = (one(TILE_LENGTH), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    grid = np.zeros((height, width, depth), np.uint8)
    across = -(-width // wide)
    for k, (place, size) in enumerate(zip(tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_COUNTS if tiled else STRIP_COUNTS], strict=True)):
        y, x = k // across * tall, k % across * wide
        lines = tall if tiled else min(tall, height - y)
        body = expand(data[place : place + size], scheme, lines * wide * depth)
        if len(body) != lines * wide * depth:
            raise ValueError("short strip or tile")
        block = np.frombuffer(body, np.uint8).reshape(lines, wide, depth)
        if predictor == 2:
            block = np.add.accumulate(block, axis=1, dtype=np.uint8)
        grid[y : y + tall, x : x + wide] = block[: height - y, : width - x]
    return {"width": width, "height": height, "channels": depth, "compression": scheme, "predictor": predictor, "tiled": tiled, "samples": grid.tobytes()}


# --- columns

PAGE = "page int, width int, height int, channels int, compression int, predictor int, tiled boolean, samples binary, error string"
#: Bytes of a batch that is handed on.
BATCH = 1 << 22


def tiff_pages(rows: DataFrame, column: str = "tiff") -> DataFrame:
    """One row per page of the files in the binary `column`, in order; the other columns are repeated.

    A page that can't be decoded gives a row with its number and the reason in `error`, and the pages behind it follow. A null
    file, or one whose chain of directories breaks, gives its pages before that and one row with page null and the reason.
    Rows of one file follow each other in one partition. An empty table gives no rows. A column of the table that
    has the name of a page column is left out.
    """
    page_names = [x.split()[0] for x in PAGE.split(", ")]
    rest = [f for f in rows.schema if f.name != column and f.name not in page_names]
    names = [f.name for f in rest]
    schema = pa.schema([("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("samples", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(column)
            taken, pages, held = [], [], 0

            def out():
                found = pa.RecordBatch.from_pylist(pages, schema)  # noqa: B023
                carried = batch.select(names).take(pa.array(taken, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([*carried.columns, *found.columns], names=[*names, *schema.names])

            for i in range(batch.num_rows):
                try:
                    data = files[i].as_py()
                    if data is None:
                        raise ValueError("no file")
                    for found in read_tiff(data):
                        pages.append(found)
                        taken.append(i)
                        held += len(found.get("samples", b""))
                        if held > BATCH:
                            yield out()
                            taken, pages, held = [], [], 0
                except ERRORS as e:
                    pages.append({"error": f"{type(e).__name__}: {e}"})
                    taken.append(i)
            if pages:
                yield out()

    pages_too = StructType([*rest, *StructType.fromDDL(PAGE)])
    return map_arrow(rows.select(*[F.col(quoted(n)) for n in (*names, column)]), run, pages_too)


def payload(text: bytes) -> bytes:
    """The text's bytes, with bytes 0 up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % 64 or 64 * (not text))


def payload_tiffs(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, tiff: each whole text (null: empty) in a file of PAGE_ROWS rows of COLUMNS samples a page.

    The pages take LAYOUTS in turn; the payload's CRC-32 says which comes first, so texts of every size use them all
    and equal texts have equal files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            at, files, sizes, held = 0, [], [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or b""
                body = payload(text)
                rows, first = np.frombuffer(body, np.uint8).reshape(-1, COLUMNS), zlib.crc32(body)
                pages = [(rows[y : y + PAGE_ROWS], *LAYOUTS[(first + k) % len(LAYOUTS)]) for k, y in enumerate(range(0, len(rows), PAGE_ROWS))]
                files.append(write_tiff(pages))
                sizes.append(len(text))
                held += len(files[-1])
                if held > BATCH or i == batch.num_rows - 1:
                    ids = batch.column("doc_id").slice(at, len(files))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "tiff"])
                    at, files, sizes, held = i + 1, [], [], 0

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, tiff binary")


_DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each file's samples, from its page rows, which follow each other; page 0 begins a file."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
    now = None

    def ended():
        size, pages = now["payload_bytes"], now["pages"]
        count = now["counts"]
        share = count[count > 0] / size
        feature = f"pages={pages};mean={now['sum'] * 1000 // size};distinct={int((count > 0).sum())};entropy={round(float(-(share * np.log2(share)).sum()), 3)};rough={now['rough'] * 1000 // size}"
        own = {k: now[k] for k in ("doc_id", "n_bytes", "payload_bytes", "media_bytes", "media_sha256")}
        return own | {"payload_sha256": now["sha"].hexdigest(), "tail_crc32": zlib.crc32(now["tail"]), "feature": feature}

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["error"] is not None:
                raise ValueError(f"doc_id {row['doc_id']}: {row['error']}")
            if row["page"] == 0:
                if now:
                    done.append(ended())
                now = {k: row[k] for k in ("doc_id", "n_bytes", "media_bytes", "media_sha256")} | {"payload_bytes": 0, "pages": 0, "sha": hashlib.sha256(), "counts": np.zeros(256, np.int64), "sum": 0, "rough": 0}
            samples = np.frombuffer(row["samples"], np.uint8)
            now["payload_bytes"] += len(samples)
            now["pages"] += 1
            now["sha"].update(row["samples"])
            now["tail"] = row["samples"][-64:]
            now["counts"] += np.bincount(samples, minlength=256)
            now["sum"] += int(samples.sum(dtype=np.int64))
            now["rough"] += int(np.abs(np.diff(samples.astype(np.int16))).sum())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now:
        yield pa.RecordBatch.from_pylist([ended()], schema)


def op3_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a TIFF file and read back page by page."""
    files = payload_tiffs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    files = files.withColumn("media_bytes", F.octet_length("tiff").cast("long")).withColumn("media_sha256", F.sha2("tiff", 256))
    return tiff_pages(files).mapInArrow(_fold_pages, _DIGESTS)
