"""Pages far into a sorted table: by key, and by rank with only the part sorted that holds the page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An order: column names, with a minus before those that descend. Nulls come first, or last in a column that descends.
Order = list[str]
#: A part of this many rows is sorted; a larger one is split into FAN.
PIECE, FAN = 100_000, 32
_PER_PART = 40


@dataclass(frozen=True)
class Page:
    """Rows of a page, and the number of all rows, also where the page is empty."""

    rows: DataFrame
    total: int


def _name(key: str) -> str:
    return key.removeprefix("-")


def sort_columns(order: Order) -> list[Column]:
    return [F.col(_name(k)).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in order]


def is_before(order: Order, values: tuple) -> Column:
    """Whether a row is before the given key. The condition never is null."""
    out = F.lit(False)
    for key, value in reversed(list(zip(order, values, strict=True))):
        c, down = F.col(_name(key)), key.startswith("-")
        if value is None:
            here = c.isNotNull() if down else F.lit(False)
            same = c.isNull()
        else:
            here = F.coalesce(c > F.lit(value), F.lit(False)) if down else F.coalesce(c < F.lit(value), F.lit(True))
            same = F.coalesce(c == F.lit(value), F.lit(False))
        out = here | (same & out)
    return out


def _first_key_between(order: Order, low: tuple | None, high: tuple | None) -> Column:
    """What the bounds say of the first key alone, in a form that reaches the scan."""
    c, down, out = F.col(_name(order[0])), order[0].startswith("-"), F.lit(True)
    if low is not None and low[0] is not None:
        out = out & ((c <= F.lit(low[0])) | c.isNull() if down else c >= F.lit(low[0]))
    if high is not None and high[0] is not None:
        out = out & (c >= F.lit(high[0]) if down else (c <= F.lit(high[0])) | c.isNull())
    return out


def after(df: DataFrame, order: Order, values: tuple | None, limit: int) -> DataFrame:
    """The next `limit` rows behind the key `values` (of the last row seen; None: from the start). No row before it is sorted."""
    if values is None:
        return df.orderBy(*sort_columns(order)).limit(limit)
    same = F.lit(True)
    for key, value in zip(order, values, strict=True):
        same = same & F.col(_name(key)).eqNullSafe(F.lit(value))
    behind = df.where(_first_key_between(order, values, None)).where(~is_before(order, values) & ~same)
    return behind.orderBy(*sort_columns(order)).limit(limit)


def _part(order: Order, bounds: list[tuple], first: int) -> Column:
    """The number of the part that a row is in: parts end before their bounds; a search of depth log2."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(is_before(order, bounds[mid]), _part(order, bounds[:mid], first)).otherwise(_part(order, bounds[mid + 1 :], first + mid + 1))


def rank_page(df: DataFrame, order: Order, limit: int, offset: int = 0, piece: int = PIECE, fan: int = FAN) -> Page:
    """Rows `offset` to `offset + limit` in `order`, and the total.

    While the part that may hold the page has more than `piece` rows, bounds are taken from a sample of keys (some hundred rows), rows are counted between
    them without a shuffle, and only the parts that hold the page are kept; their first key's range is a filter that reaches the
    scan. So a few scans that count replace the sort, and no task gets `offset` rows. `order` must tell all rows apart, or those it doesn't tell apart
    must be equal: a part that can't be split is sorted whole.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be 1 or more, offset 0 or more")
    names = [_name(k) for k in order]
    total = n = df.count()
    if offset >= total:
        return Page(df.limit(0), total)
    base, low, high, part = 0, None, None, df
    while n > piece:
        share = min(1.0, fan * _PER_PART / n)
        seen = [tuple(r) for r in part.select(*names).sample(share, seed=n).limit(4 * fan * _PER_PART).distinct().orderBy(*sort_columns(order)).collect()]
        bounds = list(dict.fromkeys(seen[len(seen) * i // fan] for i in range(1, fan))) if seen else []
        counts = {r["p"]: r["count"] for r in part.groupBy(_part(order, bounds, 0).alias("p")).count().collect()}  # `fan` rows
        ends, reach = [], base
        for i in range(len(bounds) + 1):
            reach += counts.get(i, 0)
            ends.append(reach)
        first = next(i for i, e in enumerate(ends) if e > offset)
        last = next((i for i, e in enumerate(ends) if e >= min(offset + limit, base + n)), len(bounds))
        left = ends[last] - (ends[first - 1] if first else base)
        if left == n:
            break
        base = ends[first - 1] if first else base
        low, high = (bounds[first - 1] if first else low), (bounds[last] if last < len(bounds) else high)
        n, part = left, df.where(_first_key_between(order, low, high))
        part = part if low is None else part.where(~is_before(order, low))
        part = part if high is None else part.where(is_before(order, high))
    return Page(part.orderBy(*sort_columns(order)).offset(offset - base).limit(limit), total)
