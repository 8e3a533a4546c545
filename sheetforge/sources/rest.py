"""Tables behind a REST service with a filter language: a data source that pushes filters and columns, and upserts in batches.

Requests are GET <url>/<table>?select=a,b&a=eq.1&order=id.asc&limit=..&offset=..; `Prefer: count=exact` asks for the total, which comes
in Content-Range. Rows are JSON objects. A profile header names the schema that the table belongs to.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import BinaryType, DataType, DateType, DecimalType, DoubleType, FloatType, StringType, StructType, TimestampType

PAGE, BATCH = 1000, 500
ATTEMPTS = 3
RETRIED = (403, 429, 500, 502, 503, 504)
FORMAT = "rest_table"


class RestError(RuntimeError):
    """A request that failed for good."""


def send(method: str, url: str, headers: dict, payload=None, timeout: float = 120, attempts: int = ATTEMPTS, wait: Callable = time.sleep, opener=urllib.request.urlopen):
    """(rows, total or None). Statuses above, timeouts and broken connections are tried again; any other status is an error with its text."""
    data = None if payload is None else json.dumps(payload, default=str).encode()
    for n in range(attempts):
        try:
            request = urllib.request.Request(url, headers=headers | ({"Content-Type": "application/json"} if data else {}), data=data, method=method)
            with opener(request, timeout=timeout) as answer:
                body, held = answer.read(), (answer.headers.get("Content-Range") or "").rpartition("/")[2]
                return json.loads(body) if body else [], int(held) if held.isdigit() else None
        except urllib.error.HTTPError as e:
            text = e.read().decode("utf-8", "replace")
            if e.code not in RETRIED or n == attempts - 1:
                raise RestError(f"{method} {url} failed with HTTP {e.code}: {text}") from e
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if n == attempts - 1:
                raise RestError(f"{method} {url} failed: {e}") from e
        wait(0.5 * (n + 1))
    raise ValueError("attempts must be 1 or more")


# --- the filter language


def _text(value) -> str | None:
    """A value in a filter; None if it has no form there."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (int, float, Decimal, str)):
        return str(value)
    return None


def _listed(value) -> str | None:
    text = _text(value)
    return None if text is None else '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


_COMPARE = {ds.EqualTo: "eq", ds.GreaterThan: "gt", ds.GreaterThanOrEqual: "gte", ds.LessThan: "lt", ds.LessThanOrEqual: "lte"}
_LIKE = {ds.StringStartsWith: "{}*", ds.StringEndsWith: "*{}", ds.StringContains: "*{}*"}
#: Characters that a pattern can't hold as themselves.
_WILD = set("*%_\\")


def parameter(f: ds.Filter) -> tuple[str, str] | None:
    """A filter as (column, condition) of a request, or None if the language can't say the same."""
    if isinstance(f, ds.Not):
        inner = parameter(f.child)
        # neither side holds for null, except that null tests have no null
        return None if inner is None or inner[1].startswith("not.") else (inner[0], "not." + inner[1])
    if len(f.attribute) != 1:
        return None
    name = f.attribute[0]
    if isinstance(f, ds.IsNull):
        return name, "is.null"
    if isinstance(f, ds.IsNotNull):
        return name, "not.is.null"
    if isinstance(f, ds.In):
        listed = [_listed(v) for v in f.value if v is not None]
        return None if None in listed or not listed else (name, f"in.({','.join(listed)})")
    for kind, op in _COMPARE.items():
        if type(f) is kind:
            value = _text(f.value)
            return None if value is None else (name, f"{op}.{value}")
    for kind, form in _LIKE.items():
        if type(f) is kind:
            return None if _WILD & set(f.value) else (name, "like." + form.format(f.value))
    return None


def _reader_of(kind: DataType) -> Callable:
    """What turns a JSON value into one of a column's type."""
    plain = {
        DateType: lambda v: date.fromisoformat(v[:10]), TimestampType: lambda v: datetime.fromisoformat(v), DecimalType: lambda v: Decimal(str(v)), BinaryType: lambda v: base64.b64decode(v),
        DoubleType: float, FloatType: float, StringType: lambda v: v if isinstance(v, str) else json.dumps(v, sort_keys=True, separators=(",", ":")),
    }
    turn = plain.get(type(kind), lambda v: v)
    return lambda v: None if v is None else turn(v)


# --- scan


@dataclass
class _Page(ds.InputPartition):
    offset: int
    limit: int | None


class _Scan(ds.DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.target = _Target(options)
        self.page, self.order = int(options.get("pageSize", PAGE)), options.get("order")
        self.schema, self.filters = schema, []

    def pushFilters(self, filters):
        for f in filters:
            said = parameter(f)
            if said is None:
                yield f
            else:
                self.filters.append(said)

    def _request(self, limit: int, offset: int, count: bool = False):
        query = [("select", ",".join(self.schema.names)), *self.filters, ("limit", limit), ("offset", offset)]
        if self.order:
            query.append(("order", ",".join(f"{c.strip()}.asc" for c in self.order.split(","))))
        return self.target.send("GET", query, prefer="count=exact" if count else None)

    def partitions(self) -> list[ds.InputPartition]:
        """A partition a page of the counted total. Without a total, or an order that keeps pages apart, one partition goes from page to page."""
        total = self._request(1, 0, count=True)[1] if self.order else None
        if total is None:
            return [_Page(0, None)]
        return [_Page(at, min(self.page, total - at)) for at in range(0, total, self.page)] or [_Page(0, 0)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        readers = [(f.name, _reader_of(f.dataType)) for f in self.schema.fields]
        as_row = lambda r: tuple(read(r.get(name)) for name, read in readers)
        if partition.limit is not None:
            rows = self._request(partition.limit, partition.offset)[0] if partition.limit else []
            if len(rows) < partition.limit:  # not the rows that were counted
                raise RestError(f"{self.target.table} shrank while it was read: {len(rows)} of {partition.limit} rows from {partition.offset} on")
            yield from map(as_row, rows)
            return
        offset = 0
        while True:
            rows = self._request(self.page, offset)[0]
            yield from map(as_row, rows)
            offset += len(rows)
            if len(rows) < self.page:
                return


class _Target:
    """Where a table is, and the headers that every request to it has."""

    def __init__(self, options: dict):
        schema, _, name = options["table"].rpartition(".")
        self.url, self.table = f"{options['url'].rstrip('/')}/{urllib.parse.quote(name)}", options["table"]
        self.headers = {"Accept": "application/json"}
        if schema:
            self.headers |= {"Accept-Profile": schema, "Content-Profile": schema}
        if token := options.get("token"):
            self.headers |= {"apikey": token, "Authorization": f"Bearer {token}"}
        self.attempts, self.timeout = int(options.get("attempts", ATTEMPTS)), float(options.get("timeout", 120))

    def send(self, method: str, query=(), payload=None, prefer: str | None = None):
        url = self.url + ("?" + urllib.parse.urlencode([(k, str(v)) for k, v in query]) if query else "")
        return send(method, url, self.headers | ({"Prefer": prefer} if prefer else {}), payload, self.timeout, self.attempts)


# --- upsert


@dataclass
class _Sent(ds.WriterCommitMessage):
    rows: int


class _Upsert(ds.DataSourceWriter):
    """Rows go out in batches; a batch that is sent again merges with itself, so a task that is run twice changes nothing."""

    def __init__(self, options: dict, schema: StructType):
        self.target, self.size, self.names = _Target(options), int(options.get("batchSize", BATCH)), schema.names
        self.key = options.get("key", "id")

    def write(self, iterator: Iterator) -> _Sent:
        held, n = [], 0

        def flush():
            if held:
                self.target.send("POST", [("on_conflict", self.key)], list(held), "resolution=merge-duplicates,return=minimal")
                held.clear()

        for row in iterator:
            held.append(dict(zip(self.names, row, strict=True)))
            n += 1
            if len(held) == self.size:
                flush()
        flush()
        return _Sent(n)


class RestTable(ds.DataSource):
    """spark.read.format("rest_table").schema(...).options(url=, table="schema.table", order="id", pageSize=, token=).

    Only the columns of the schema that is given are asked for. Equality, comparison, `in`, null tests and simple `like` filters go into the requests; all
    others are left to Spark. `order` names columns that tell rows apart: with it each page of the counted total is a partition,
    and a page that comes back short is an error. Writing (mode append) upserts on `key` in batches of `batchSize`.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("a schema must be given")

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return _Scan(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:
        if overwrite:
            raise ValueError("only append is possible: rows are merged by key")
        return _Upsert(self.options, schema)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets filters reach sources written in Python."""
    spark.dataSource.register(RestTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def rest_table(spark: SparkSession, url: str, table: str, schema: str | StructType, columns: list[str] | None = None, **options) -> DataFrame:
    """Rows of a table, with only the columns that are named."""
    register(spark)
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = full if columns is None else StructType([full[c] for c in columns])
    return spark.read.format(FORMAT).schema(wanted).options(url=url, table=table, **options).load()


def rest_total(url: str, table: str, filters: list[tuple[str, str]] = (), **options) -> int | None:
    """The number of rows that meet the conditions (column, condition); None if the service doesn't say."""
    return _Target({"url": url, "table": table} | options).send("GET", [("select", "*"), *filters, ("limit", 1)], prefer="count=exact")[1]


def rest_page(url: str, table: str, columns: list[str], filters: list[tuple[str, str]] = (), order: str | None = None, limit: int = 25, offset: int = 0, **options) -> tuple[list[dict], int | None]:
    """(rows, total) of one page: for an interface that shows a page at a time."""
    query = [("select", ",".join(columns)), *filters, ("limit", limit), ("offset", offset), *([("order", order)] if order else [])]
    return _Target({"url": url, "table": table} | options).send("GET", query, prefer="count=exact")


def rest_upsert(df: DataFrame, url: str, table: str, key: str = "id", batch: int = BATCH, **options) -> None:
    """All rows upserted on `key`; several tasks send at once."""
    register(df.sparkSession)
    df.write.format(FORMAT).options(url=url, table=table, key=key, batchSize=batch, **options).mode("append").save()


def rest_delete(url: str, table: str, filters: list[tuple[str, str]], **options) -> None:
    """Deletes the rows that meet all conditions, of which there must be one."""
    if not filters:
        raise ValueError("a removal needs a condition")
    _Target({"url": url, "table": table} | options).send("DELETE", filters, prefer="return=minimal")
