"""PDF bytes to page text, where the optional library is installed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extract

#: How far apart letters of one word may be.
WORDS = {"x_tolerance": 1.5, "y_tolerance": 3, "keep_blank_chars": False}
PLACED = "path string, page_number int, text string, words array<struct<word:string,top:double,x0:double>>"


def available() -> bool:
    from importlib.util import find_spec

    return find_spec("pdfplumber") is not None


def _opened(content: bytes) -> Any:
    import io

    import pdfplumber

    return pdfplumber.open(io.BytesIO(content))


def pages(files: DataFrame, opened: Callable[[bytes], Any] | None = None) -> DataFrame:
    """(path, page_number, text, words) of a table (path, content); `opened` reads a file's bytes, by default with pdfplumber.

    One file at a time is in memory, and a row a page leaves the worker at once. A page without text has an empty one.
    """
    if opened is None and not available():
        raise RuntimeError("pdfplumber isn't installed; begin with a table of page text (doc_key, page_number, text)")
    read = opened or _opened

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with read(content) as document:
                    for n, page in enumerate(document.pages, 1):
                        words = [{"word": w["text"], "top": float(w["top"]), "x0": float(w["x0"])} for w in page.extract_words(**WORDS) or []]
                        yield pd.DataFrame({"path": [path], "page_number": [n], "text": [page.extract_text() or ""], "words": [words]})

    return files.select("path", "content").mapInPandas(run, PLACED)


def page_text(files: DataFrame, opened: Callable[[bytes], Any] | None = None) -> DataFrame:
    """(path, page_number, text), each text followed by the page's part-number block as its placed words give it, where the
    text itself doesn't have it so. Every file is opened once."""
    return extract.with_pin_block(pages(files, opened), "words", ["path", "page_number", "text"])


def words(files: DataFrame, opened: Callable[[bytes], Any] | None = None) -> DataFrame:
    """(path, page_number, word, top, x0): input of operators.extract.word_lines."""
    return pages(files, opened).select("path", "page_number", F.inline("words"))
