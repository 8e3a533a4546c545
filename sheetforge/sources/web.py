"""Web index pages: fetching with retries as a Python data source, and parsing in expressions."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import text as t
from ..functions.values import month_date
from ..operators.relational import latest, pick
from . import store

RETRIED = (403, 429, 500, 502, 503, 504)
ATTEMPTS = 3
PAUSE = 0.75


def fetch(url: str, timeout: float = 60, attempts: int = ATTEMPTS, opener=None, wait=time.sleep, headers: dict | None = None) -> bytes | None:
    """The body of a page: retried on the statuses above, timeouts and broken connections, with growing pauses; None if it doesn't exist. Certificates are checked."""
    import urllib.error
    import urllib.request

    opener = opener or urllib.request.build_opener(urllib.request.HTTPCookieProcessor()).open
    for n in range(attempts):
        try:
            with opener(urllib.request.Request(url, headers=headers or {"User-Agent": "catalog"}), timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if e.code not in RETRIED or n == attempts - 1:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError):  # no answer, or a broken one
            if n == attempts - 1:
                raise
        wait(1.5 * (n + 1))
    return None


class _Url(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(0)
        self.urls = urls


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = options["urls"].split()
        self.size = int(options.get("urlsPerPartition", 16))
        self.pause = float(options.get("pause", PAUSE))

    def partitions(self) -> list[InputPartition]:
        return [_Url(self.urls[i : i + self.size]) for i in range(0, len(self.urls), self.size)]

    def read(self, partition: _Url) -> Iterator[tuple]:
        for i, url in enumerate(partition.urls):
            if i:
                time.sleep(self.pause)
            body = fetch(url)
            yield url, body.decode("utf-8", "replace") if body is not None else None


class WebPages(DataSource):
    """spark.read.format("web_pages").option("urls", ...): (url, html); html is null for pages that don't exist."""

    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return "url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)


class _SearchReader(DataSourceReader):
    """A search is a state that goes from page to page, so one search is one partition; several searches go on at once, `parallel` at most."""

    def __init__(self, options: dict):
        self.url, self.terms = options["url"], [x for x in options["terms"].split("\n") if x.strip()]
        self.field, self.pause = options.get("field", "DocumentIDTextBox"), float(options.get("pause", PAUSE))
        self.parallel, self.most = int(options.get("parallel", 4)), int(options.get("mostPages", 1000))

    def partitions(self) -> list[InputPartition]:
        """The searches are dealt over `parallel` partitions, so that the site never has more askers than that."""
        return [_Url(self.terms[i :: self.parallel]) for i in range(min(self.parallel, len(self.terms)))] or [_Url([])]

    def read(self, partition: _Url) -> Iterator[tuple]:
        for n, term in enumerate(partition.urls):
            if n:
                time.sleep(self.pause)
            yield from self._search(term)

    def _search(self, term: str) -> Iterator[tuple]:
        import http.cookiejar
        import urllib.request
        from urllib.parse import urlencode

        jar = urllib.request.HTTPCookieProcessor(http.cookiejar.CookieJar())  # the site's own state, kept over the pages of one search
        opener, ordinal, seen = urllib.request.build_opener(jar).open, 0, set()
        url = f"{self.url}?{urlencode({self.field: term})}"
        for page in range(self.most):
            if page:
                time.sleep(self.pause)
            body = fetch(url, opener=opener)
            if body is None:
                return
            html, mark = body.decode("utf-8", "replace"), hashlib.sha256(body).digest()
            if mark in seen:  # the site goes round
                return
            seen.add(mark)
            for cells, href in grid(html):
                yield term, page, ordinal, cells, href
                ordinal += 1
            if (onward := next_page(html)) is None:
                return
            url = urljoin(url, onward)


class GridSearch(DataSource):
    """spark.read.format("grid_search").options(url=, terms=one a line, field=, pause=, parallel=): (term, page, ordinal, cells, href).

    The search box is filled with each term, and the result's pages are followed to the one without a next page, or one seen before. Rows keep their order
    within a search. `grid_rows` makes documents of them.
    """

    @classmethod
    def name(cls) -> str:
        return "grid_search"

    def schema(self) -> str:
        return "term string, page int, ordinal int, cells array<string>, href string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


def grid(html: str) -> Iterator[tuple[list[str], str | None]]:
    """The cells' texts of each row of a result grid, and the row's first link."""
    import html as entities
    import re

    for row in re.findall(r'(?is)<tr[^>]*class="[^"]*\bgrid_(?:item|alternate)\b[^"]*"[^>]*>(.*?)</tr>', html):
        cells = [" ".join(entities.unescape(re.sub(r"(?s)<[^>]+>", "", c)).split()) for c in re.findall(r"(?is)<td[^>]*>(.*?)</td>", row)]
        link = re.search(r'(?i)<a\s[^>]*href="([^"]*)"', row)
        yield cells, entities.unescape(link[1]) if link else None


def next_page(html: str) -> str | None:
    """Where the next page of a result is."""
    import html as entities
    import re

    for attributes in re.findall(r"(?i)<a\s([^>]*)>", html):
        if re.search(r"""(?i)\brel=["']?next\b""", attributes) and (link := re.search(r'(?i)\bhref="([^"]*)"', attributes)):
            return entities.unescape(link[1])
    return None


def register(spark) -> None:
    """Makes the formats `web_pages` and `grid_search` known to a session."""
    spark.dataSource.register(WebPages)
    spark.dataSource.register(GridSearch)


def links(html: Column | str) -> Column:
    """array<struct<href, text>> of the anchors of a page, in order."""
    hrefs = F.regexp_extract_all(t.col(html), F.lit(r'<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(1))
    texts = F.regexp_extract_all(t.col(html), F.lit(r'<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(2))
    return F.transform(F.arrays_zip(hrefs.alias("a"), texts.alias("b")), lambda x: F.struct(x["a"].alias("href"), t.strip_tags(x["b"]).alias("text")))


def grid_rows(cells: DataFrame, family: str = r"\d{5}") -> DataFrame:
    """Documents of a search grid: rows (cells array, ordinal) with six cells or more, a document id, status A and a number;
    the latest by date of each key, the first of equals."""
    doc_id = F.upper(F.trim(F.get("cells", F.lit(1))))
    shape = rf"^MIL-DTL-{family}(?:/(\d{{1,2}}))?([A-Z])(?:\(\d+\))?(?:\s+NOT\s+\d+)?$"
    rows = cells.where((F.size("cells") >= 6) & (F.get("cells", F.lit(2)) == "A") & doc_id.rlike(shape) & (F.coalesce(F.get("cells", F.lit(5)), F.lit("")) != ""))
    key = F.coalesce(t.blank_to_null(F.regexp_extract(doc_id, shape, 1)), F.lit("base"))
    rows = rows.select("ordinal", doc_id.alias("doc_id"), key.alias("document_key"), F.regexp_extract(doc_id, shape, 2).alias("revision"), F.get("cells", F.lit(3)).alias("title"), F.get("cells", F.lit(4)).alias("doc_date_text"), F.get("cells", F.lit(5)).alias("ident"))
    return latest(rows.withColumn("doc_date", month_date("doc_date_text")), ["document_key"], "doc_date", "ordinal")


def found_documents(found: DataFrame, family: str = r"\d{5}") -> DataFrame:
    """Documents of a `grid_search`: the latest by date of each key over all its terms, the first of equals; a row without an ident number in its link is none."""
    ident = t.blank_to_null(F.regexp_extract("href", r"(?i)ident_number=(\d+)", 1))
    cell = lambda i: F.get("cells", F.lit(i))
    return grid_rows(found.select(F.struct("term", "ordinal").alias("ordinal"), F.array(cell(0), cell(1), F.upper(cell(2)), cell(5), cell(4), ident).alias("cells")), family)


def is_other_notice(description: Column | str) -> Column:
    """Notices, validations and administrative rows aren't revisions."""
    return t.col(description).rlike(r"(?i)\b(?:notice|validation|administrative)\b")


def revision_entries(pages: DataFrame) -> DataFrame:
    """(page, token, description, document_date, revision_letter) from revision-history tables, one row a token.

    Cells are read in their places first; rows of another build are read as text, for tokens not yet seen.
    """
    rows = pages.select("page", F.posexplode(F.split("html", "(?i)</tr>")).alias("i", "row"))
    token = F.regexp_extract("row", r"token=(\d+\.\d+)", 1)
    rows = rows.withColumn("token", token).where("token != ''")
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)(?=</td>|<td|$)"), F.lit(1)), lambda x: t.strip_tags(x))
    as_text = t.strip_tags("row", True)
    described = r"(?i)(Revision\s+[A-Z](?:,?\s*(?:\(?incorporating\s+)?amendment\s+\d+\)?)?(?:\s*-[^()]*?)?(?:\s*\([^)]*\))?)(?=\s|$)"
    date = r"(\d{2}-[A-Za-z]{3}-\d{4})"
    cell = F.get(F.filter(cells, lambda x: x.rlike(r"(?i)^Revision\s+[A-Z]\b") | is_other_notice(x)), F.lit(0))
    found = rows.select("page", "i", "token", F.coalesce(cell, t.blank_to_null(F.regexp_extract(as_text, described, 1))).alias("description"), cell.isNull().alias("fallback"), F.regexp_extract(as_text, date, 1).alias("date_text"))
    found = found.withColumn("document_date", F.expr("cast(try_to_timestamp(initcap(date_text), 'dd-MMM-yyyy') as date)"))
    letter = F.upper(F.regexp_extract("description", r"(?i)^Revision\s+([A-Z])\b", 1))
    found = found.where(~is_other_notice("description") & (letter != "")).withColumn("revision_letter", letter)
    return pick(found, ["page", "token"], F.col("fallback").asc(), F.col("i").asc()).select("page", "token", "description", "document_date", "revision_letter", F.col("i").alias("ordinal"))


def latest_revision(entries: DataFrame, letter: str | None = None) -> DataFrame:
    """The newest entry of each page, of one letter if it is given; pages without an entry have no row."""
    rows = entries if letter is None else entries.where(F.col("revision_letter") == letter.upper())
    return latest(rows, ["page"], "document_date", "ordinal")


def require_revision(row_count: Column) -> Column:
    """An error, when evaluated, for pages without a revision."""
    return F.assert_true(row_count > 0, F.lit("no revision rows were found"))


def redirect_target(html: Column | str) -> Column:
    """Where a redirecting page leads: its link to the file service, else a redirection; null where there is neither."""
    service = r'href="(\.\./\.\./WMX/Default\.aspx\?token=\d+)"'  # a fixed value
    return F.coalesce(t.blank_to_null(F.regexp_extract(t.col(html), service, 1)), _redirection(html))


def _redirection(html: Column | str) -> Column:
    return t.blank_to_null(F.regexp_extract(t.col(html), r"""(?i)(?:location(?:\.href)?\s*=\s*|url=)['"]?([^'"\s>;]+)""", 1))


def _each(rows: DataFrame, more: str, one: Callable[..., tuple], columns: tuple[str, ...], pause: float) -> DataFrame:
    """The rows with the columns `more`, that `one` gives for the values of `columns`; a task pauses between its rows."""
    added = StructType.fromDDL(more)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for batch in batches:
            for i in range(len(batch)):
                if n:
                    time.sleep(pause)
                n += 1
                row = batch.iloc[[i]]
                values = one(*(None if pd.isna(row[c].iat[0]) else row[c].iat[0] for c in columns))
                yield row.assign(**{f.name: pd.array([x], dtype="Int64" if isinstance(x, int) else object) for f, x in zip(added, values, strict=True)})

    return rows.mapInPandas(run, StructType(rows.schema.fields + added.fields))


def fetched(rows: DataFrame, base: str, link: str, pause: float = PAUSE, get: Callable[[str], bytes | None] = fetch) -> DataFrame:
    """Adds url and html, the page of each row, its link read against its base; html is null for pages that don't exist, both
    for rows without link."""

    def one(b: str | None, x: str | None) -> tuple:
        url = None if x is None else urljoin(b or "", x)
        body = None if url is None else get(url)
        return url, None if body is None else body.decode("utf-8", "replace")

    return _each(rows, "url string, html string", one, (base, link), pause)


def landed(rows: DataFrame, base: str, link: str, folder: str, pause: float = PAUSE, get: Callable[[str], bytes | None] = fetch) -> DataFrame:
    """Adds pdf_url, saved_to, checksum, n_bytes and error: executors fetch each link and put the file into the folder under the
    row's file_name, one at a time in memory. What isn't there, has no link or isn't a PDF is an error and leaves no file."""

    def one(b: str | None, x: str | None, name: str | None) -> tuple:
        if x is None or name is None:
            return None, None, None, None, "no link"
        url = urljoin(b or "", x)
        body = get(url)
        if body is None:
            return url, None, None, None, "not found"
        if not body.startswith(b"%PDF"):
            return url, None, None, None, "not a PDF"
        place = f"{folder.rstrip('/')}/{name}"
        return url, place, store.put(place, iter([body])), len(body), None

    return _each(rows, "pdf_url string, saved_to string, checksum string, n_bytes long, error string", one, (base, link, "file_name"), pause)


def download_family(docs: DataFrame, folder: str, report: str, letter: str | None = None, pause: float = PAUSE, get: Callable[[str], bytes | None] = fetch) -> DataFrame:
    """Downloads the latest revision of each document (document_key, details_url) and writes what became of it as a report.

    From the details page to the newest revision, by its token to the page that redirects, from there to the file. A document
    without revision, without link or whose file isn't a PDF has an error in the report; the others aren't held up. The report
    is written once and read from there, so looking at it fetches nothing; each page is fetched once a document.
    """
    keyed = docs.select("document_key", "details_url")
    details = fetched(keyed.withColumn("_base", F.lit("")), "_base", "details_url", pause, get)
    newest = latest_revision(revision_entries(details.select(F.col("document_key").alias("page"), "html")), letter)
    asked = keyed.join(newest.select(F.col("page").alias("document_key"), "revision_letter", "document_date", "token"), "document_key", "left")
    pages = fetched(asked.withColumn("_link", F.concat(F.lit("./ImageRedirector.aspx?token="), "token")), "details_url", "_link", pause, get)
    name = F.concat(F.lit("MIL-DTL-83513_"), t.sheet_key("document_key"), F.lit("_rev_"), "revision_letter", F.lit(".pdf"))
    named = pages.select("document_key", "details_url", "revision_letter", "document_date", F.col("url").alias("redirector_url"), redirect_target("html").alias("target"), name.alias("file_name"))
    out = landed(named, "redirector_url", "target", folder, pause, get).drop("target")
    out = out.withColumn("error", F.when(F.col("revision_letter").isNull(), "no revision").otherwise(F.col("error")))
    store.write_report(out, report)
    return docs.sparkSession.read.schema(out.schema).json(report)
