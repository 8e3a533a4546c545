"""Every operator as a query over the shared test tables, with the SQL that gives the same rows."""

from . import aggregates, joins, page_texts, plans, predicates, releases, scale, texts
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "aggregates", "joins", "page_texts", "plans", "predicates", "releases", "scale", "texts"]
