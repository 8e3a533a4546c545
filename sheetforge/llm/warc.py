"""WARC archives: a writer with revisits, and a salvage reader that recovers what follows damage."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _files
from ._common import small_side, work_dir

#: Payloads of fewer bytes are always stored again.
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
#: An archive is closed when it has so many bytes.
ARCHIVE = 1 << 28
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
_VERSION_LINE = re.compile(rb"WARC/\d\.\d\r?\n")
#: Bytes read at a time.
STEP = 1 << 18
#: Bytes handed to zlib at a time.
PIECE = 1 << 16


# --- records


def record(kind: str, record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None = None) -> bytes:
    """One record; a revisit keeps the HTTP header with the payload's length, but not the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


class Broken(ValueError):
    """A record or member that fails a check."""


def _same(name: str, told: str, block: bytes) -> bool:
    """Whether a digest (hex or base 32) is the block's; true for kinds of digests that aren't checked."""
    if name not in ("sha1", "sha256"):
        return True
    own = hashlib.new(name, block).digest()
    return told.lower() == own.hex() or told.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")


def parse(s: _Bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header, block, end) of the record at position `at`; raises Broken if a check fails."""
    s.reach(at + 16)
    if not _VERSION_LINE.match(s.data, at - s.base):
        raise Broken("no version line")
    stop = s.find(END, at)
    if stop < 0:
        raise Broken("no end of header")
    lines = s.cut(at, stop).decode("utf-8", "replace").split("\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if "warc-type" not in head or not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        raise Broken("no type or length")
    start = stop + len(END)
    end = start + int(head["content-length"])
    if end + len(END) > s.most or not s.reach(end + len(END)):
        raise Broken("the record is cut off")
    if s.cut(end, end + len(END)) != END:
        raise Broken("the block doesn't end where it should")
    block = s.cut(start, end)
    name, _, told = head.get("warc-block-digest", "").partition(":")
    if not _same(name, told, block):
        raise Broken("block digest differs")
    return head, block, end + len(END)


class _Bytes:
    """Bytes of an archive, read as they are asked for; `data` holds those from position `base` on.

    grow() reads on and returns whether bytes came; low and high give where in the archive the bytes from a position on
    begin, and where those before it end. No position beyond `most` can be reached.
    """

    def __init__(self, read, most: float):
        self.read, self.most, self.data, self.base, self.found, self.over = read, most, bytearray(), 0, {}, None

    def reach(self, stop: int) -> bool:
        while self.base + len(self.data) < stop:
            if not self.grow():
                return False
        return True

    def cut(self, start: int, stop: int) -> bytes:
        return bytes(self.data[start - self.base : stop - self.base])

    def drop(self, stop: int) -> None:
        del self.data[: stop - self.base]
        self.base = stop

    def find(self, mark: bytes, at: int, drop: bool = False) -> int:
        """Where `mark` is next from `at` on, or -1; with `drop`, bytes before that aren't kept."""
        first, place = self.found.get(mark, (at + 1, at))
        if not (first <= at and (place < 0 or at <= place)):
            first = at
            while (place := self.data.find(mark, at - self.base)) < 0:
                at = max(at, self.base + len(self.data) - len(mark) + 1)
                if drop:
                    self.drop(at)
                if not self.grow():
                    break
            place = self.base + place if place >= 0 else -1
            self.found[mark] = first, place
        if drop and place >= 0:
            self.drop(place)
        return place


class _Plain(_Bytes):
    """A whole plain archive."""

    def grow(self) -> bool:
        data = self.read(self.base + len(self.data))
        self.data += data
        return bool(data)

    def low(self, at: int) -> int:
        return at

    high = low


class _Member(_Bytes):
    """The gzip member at `start`, inflated a step at a time; zlib checks its CRC and length at its end.

    Bytes inflated before damage are kept. `used` is where the next byte to inflate lies; `over` is None while more
    may come, "" after a sound member's end, else the damage.
    """

    def __init__(self, read, start: int):
        super().__init__(read, float("inf"))
        self.start = self.used = start
        self.inflate, self.rest, self.over = zlib.decompressobj(31), b"", None
        self.steps = [(0, start)]  # (position, used) after each step whose bytes are held

    def grow(self) -> bool:
        while self.over is None:
            piece = self.rest or self.read(self.used)
            before = self.inflate.copy() if self.used > self.start else zlib.decompressobj(31)
            try:
                out = self.inflate.decompress(piece, STEP)
                self.rest = b"" if self.inflate.eof else self.inflate.unconsumed_tail
                self.used += len(piece) - len(self.rest) - len(self.inflate.unused_data)
                if self.inflate.eof:
                    self.over = ""
                elif not piece and not out:
                    self.over = "Broken: the member is cut off"
            except zlib.error as e:
                out, self.over = self._sound(before, piece), f"error: {e}"
            self.data += out
            if out:
                self.steps.append((self.base + len(self.data), self.used))
                return True
            if self.steps[-1][0]:
                self.steps[-1] = (self.steps[-1][0], self.used)
        return False

    def _sound(self, inflate, piece: bytes) -> bytes:
        """What the bytes of `piece` before the damage give."""
        out = []
        for i in range(len(piece)):
            try:
                out.append(inflate.decompress(piece[i : i + 1]))
            except zlib.error:
                break
            self.used += 1
        return b"".join(out)

    def drop(self, stop: int) -> None:
        super().drop(stop)
        while len(self.steps) > 1 and self.steps[1][0] <= stop:
            del self.steps[0]

    def low(self, at: int) -> int:
        return next(used for end, used in reversed(self.steps) if end <= at)

    def high(self, at: int) -> int:
        return next(used for end, used in self.steps if end >= at)


class Salvage:
    """Reads a plain or gzipped archive from a random-access file.

    Iterating gives ("record", offset, end, header, block) and ("gap", offset, end, reason). After a failed check the
    next version line of a valid record is searched for, inside a gzip member among its inflated bytes; after damage that
    stops zlib, the next member that begins with a version line. What was inflated before the damage is kept, and the
    bytes between are a gap. Offsets of a record or gap inside a gzip member enclose it, as far as steps of reading
    tell. Records are given as soon as their own checks pass; a member's CRC that fails later is a gap behind them (a member
    of one record is a gap then), and what no digest covers, such as a header's text, is held to the format only. Memory holds a record, as long as its header says
    (if that is damaged, at most the rest of the member), and a step.
    """

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.window, self.at = b"", 0

    def _read(self, at: int, size: int = STEP) -> bytes:
        return self.source.read_at(min(size, self.size - at), at) if at < self.size else b""

    def _piece(self, at: int) -> bytes:
        """Some bytes from `at` on, cut from the step that was read last or a new one."""
        if not self.at <= at < self.at + len(self.window):
            self.window, self.at = self._read(at), at
        return self.window[at - self.at : at - self.at + PIECE]

    def __iter__(self):
        if self._read(0, 3) != GZIP and (_VERSION_LINE.match(self._read(0, 16)) or self._search(0) is None):
            lost, why = yield from self._records(_Plain(self._read, self.size))
            if lost is not None:
                yield "gap", lost, self.size, why
            return
        at = 0
        while at < self.size:
            lost, why = at, "Broken: no gzip member"
            if self._piece(at)[:3] == GZIP or self._read(at, 3) == GZIP:
                member = _Member(self._piece, at)
                lost, why = yield from self._records(member)
                if not member.over:
                    at = member.used
                    if lost is not None:
                        yield "gap", lost, at, why
                    continue
                lost, why = member.steps[-1][1] if lost is None else lost, member.over
            onward = self._search(lost + 1)
            at = self.size if onward is None else onward
            yield "gap", lost, at, why

    def _records(self, s: _Bytes):
        """The records of `s` and the gaps before them; returns the offset and the reason of a gap that ends with `s`, or None."""
        at, lost, why = 0, None, None
        while at >= 0 and s.reach(at + 1):
            try:
                head, block, end = parse(s, at)
            except Broken as e:
                if lost is None:
                    lost, why = s.low(at), f"Broken: {e}"
                at = s.find(b"WARC/", at + 1, drop=True)
                continue
            more = s.reach(end + 1)  # so that a member's end is known
            if at == 0 and not more and "data check" in (s.over or ""):
                return s.low(0), s.over
            if lost is not None:
                yield "gap", lost, s.high(at), why
                lost = why = None
            yield "record", s.low(at), s.high(end), head, block
            at = end
            s.drop(at)
        return lost, why

    def _search(self, at: int) -> int | None:
        """Where the next gzip member that begins with a version line begins."""
        while at < self.size:
            data = self._read(at)
            place = data.find(GZIP)
            while place >= 0:
                if self._good(at + place):
                    return at + place
                place = data.find(GZIP, place + 1)
            if at + len(data) >= self.size:
                return None
            at += len(data) - len(GZIP) + 1
        return None

    def _good(self, at: int) -> bool:
        try:
            return bool(_VERSION_LINE.match(zlib.decompressobj(31).decompress(self._read(at, 512), 64)))
        except zlib.error:
            return False


# --- tables


def _id(page: int | None) -> str:
    return "urn:page:" + ("none" if page is None else str(page))


def _page(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return int(value) if re.fullmatch(r"-?\d+", value) else None


def _write(folder: str, compressed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size, names = None, "", 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, first = (batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "digest", "first_id"))
                revisit = first is not None and page != first
                data = record("revisit" if revisit else "response", _id(page), url or "", (html or "").encode("utf-8", "replace"), digest, _id(first) if revisit else None)
                if compressed:
                    z = zlib.compressobj(4, zlib.DEFLATED, 31)
                    data = z.compress(data) + z.flush()
                if out is None or size > ARCHIVE:
                    if out is not None:
                        out.close()
                    name, size = _files.new_name(folder, ".warc.gz" if compressed else ".warc"), 0
                    out = _files.writer(name)
                    names.append(name)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(names)], names=["archive"])

    return run


def write_archives(pages: DataFrame, folder: str, compressed: bool = True, least: int = LEAST) -> DataFrame:
    """Writes a record per row of (page_id, url, html) and returns the table of archives' names.

    Payload: html in UTF-8 (null: empty). Of equal payloads of `least` bytes or more, the row with the smallest page_id
    is a response and the others are revisits that refer to it. A null page_id is larger than any other; rows that
    repeat the smallest page_id are all responses; a group without any page_id has responses only. Only digests of payloads
    that occur more than once are joined back, by broadcast where they are few; then pages aren't shuffled.
    """
    rows = pages.select("page_id", "url", "html", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    long = rows.where(F.octet_length("html") >= least).select("page_id", "digest")
    groups = long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(small_side(groups), "digest", "left").select("page_id", "url", "html", "digest", "first_id")
    names = marked.mapInArrow(_write(folder, compressed), "archive string").collect()  # a name or a few for each task
    return pages.sparkSession.createDataFrame([(r["archive"],) for r in names], "archive string")


_READ = "archive string, kind string, start long, end long, record_id string, record_type string, uri string, digest string, refers_to string, payload binary, payload_bytes long, reason string"


def read_archives(archives: DataFrame, column: str = "archive") -> DataFrame:
    """One row per record (kind `record`) and per quarantined run of bytes (kind `gap`, with start, end and reason).

    payload is null for revisits, whose payload_bytes is what the kept HTTP header says.
    """
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in _READ.split(", "))])

    def rows(name: str) -> Iterator[dict]:
        with _files.reader(name) as source:
            for found in Salvage(source):
                out = {"archive": name, "kind": found[0], "start": found[1], "end": found[2]}
                if found[0] == "gap":
                    yield out | {"reason": found[3]}
                    continue
                head, block = found[3:]
                http, _, payload = block.partition(END) if head.get("content-type", "").startswith("application/http") else (b"", b"", block)
                revisit = head["warc-type"] == "revisit"
                length = re.search(rb"content-length:[ \t]*(\d+)", http, re.I)
                yield out | {
                    "record_id": head.get("warc-record-id"),
                    "record_type": head["warc-type"],
                    "uri": head.get("warc-target-uri"),
                    "digest": head.get("warc-payload-digest"),
                    "refers_to": head.get("warc-refers-to"),
                    "payload": None if revisit else payload,
                    "payload_bytes": int(length[1]) if revisit and length else len(payload),
                }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(column).to_pylist():
                held, size = [], 0
                for row in rows(name):
                    held.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    n = max(1, archives.count())
    return archives.select(column).repartition(n).mapInArrow(run, _READ)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back from them; a gap in an archive just written is an error."""
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), work_dir(spark, "warc"))
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, ':(-?[0-9]+)>', 1) as long)")
    told = F.substring_index("digest", ":", -1)
    gap = F.format_string("gap in %s, bytes %d to %d: %s", "archive", "start", "end", "reason")
    return (
        read_archives(archives)
        .where(F.when(F.col("kind") == "record", F.lit(True)).otherwise(F.raise_error(gap).cast("boolean")))
        .select(
            number("record_id").alias("page_id"),
            "payload_bytes",
            F.when(F.col("record_type") == "revisit", told).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
            "record_type",
            number("refers_to").alias("refers_to"),
        )
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
