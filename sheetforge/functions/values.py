"""Identifiers, numbers, dates, arrays, maps and JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, col, join_present

URL_NAMESPACE = uuid.NAMESPACE_URL.hex


def falsy_to_blank(c: Column | str) -> Column:
    """A number as text; null and 0 give an empty string."""
    return F.coalesce(F.nullif(col(c), F.lit(0)).cast("string"), F.lit(""))


def sha1_key(prefix: str, n: int, *parts: Column) -> Column:
    """prefix + the first n hex digits of the SHA-1 of the parts joined by |; a null part counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.left(F.sha1(joined), F.lit(n)))


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """RFC 4122 version 5 from built-in functions."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8")))
    variant = F.substr(F.lit("89ab"), F.conv(F.substr(h, F.lit(17), F.lit(1)), 16, 10).cast("int") % 4 + 1, F.lit(1))
    part = lambda a, n: F.substr(h, F.lit(a), F.lit(n))
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def stable_id(kind: str, *parts: Column, prefix: str = "spec-catalog") -> Column:
    return uuid5(F.concat_ws("|", F.lit(prefix), F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def file_sha256(content: Column | str) -> Column:
    return F.sha2(col(content), 256)


def short_number(c: Column | str) -> Column:
    """The shortest form of a number with two decimals at most: 3, 2.5, 2.25."""
    text = col(c).cast("decimal(12,2)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def clamped_score(start: float, *deductions: Column) -> Column:
    """start less all deductions, 0 at least."""
    out = F.lit(start)
    for d in deductions:
        out = out - d
    return F.greatest(out, F.lit(0.0))


def ordinal(offset: Column | str, size: int) -> Column:
    """The number, from 1, of the piece that begins at `offset`."""
    return (F.floor(col(offset) / size) + 1).cast("int")


def month_date(c: str) -> Column:
    """dd-MON-yyyy in any case, or null."""
    return F.expr(f"cast(try_to_timestamp(initcap({c}), 'dd-MMM-yyyy') as date)")


def run_stamp(c: Column | str) -> Column:
    """A run id from a timestamp."""
    return F.date_format(col(c), "yyyyMMdd'T'HHmmss'Z'")


def iso_stamp(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def array_or_empty(c: Column | str, kind: str = "string") -> Column:
    return F.coalesce(col(c), F.array().cast(f"array<{kind}>"))


def json_or(c: Column | str, default: str = "{}") -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def canonical_json(**fields: Column) -> Column:
    """A JSON object with its keys in order; null fields are left out."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def json_options(c: Column | str, path: str = "hardware_options", keys=("code", "description")) -> Column:
    """The objects of a JSON array at `path` that have a first key; anything of another shape gives an empty array."""
    kind = "struct<" + ",".join(f"{k}:string" for k in keys) + ">"
    parsed = F.from_json(F.get_json_object(col(c), f"$.{path}"), f"array<{kind}>", {"mode": "PERMISSIVE"})
    return F.coalesce(F.filter(parsed, lambda x: x[keys[0]].isNotNull()), F.array().cast(f"array<{kind}>"))


# --- display


def torque_text(low, high, thread, scope, context, reference, citation) -> Column:
    """A range or single value with its thread, scope, reference and citation."""
    one = short_number(low)
    both = F.when(col(low).isNotNull() & col(high).isNotNull() & (col(low) != col(high)), F.concat(one, F.lit("-"), short_number(high))).otherwise(F.coalesce(one, short_number(high)))
    return join_present(
        " ", F.regexp_replace(col(context), "_", " "), F.when(both.isNotNull(), F.concat(both, F.lit(" in-lbf"))), col(thread),
        F.when(F.coalesce(col(scope), F.lit("")) != "", F.concat(F.lit("("), col(scope), F.lit(")"))),
        F.when(F.coalesce(col(reference), F.lit("")) != "", F.concat(F.lit("per "), col(reference))),
        F.when(F.coalesce(col(citation), F.lit("")) != "", F.concat(F.lit("["), col(citation), F.lit("]"))),
    )


def effective_torque_text(low, high, thread, scope, governing, inherited, needs_review, verified) -> Column:
    """A value with its governing sheet and one of: needs review, verified; and whether it is inherited."""
    value = F.when(col(low) != col(high), F.concat(short_number(low), F.lit("-"), short_number(high))).otherwise(short_number(low))
    return join_present(
        " ", F.concat(value, F.lit(" in-lbf")), col(thread),
        F.when(F.coalesce(col(scope), F.lit("")) != "", F.concat(F.lit("("), col(scope), F.lit(")"))),
        F.when(F.coalesce(col(governing), F.lit("")) != "", F.concat(F.lit("governing "), col(governing))),
        F.when(col(inherited), F.lit("inherited")),
        F.when(col(needs_review), F.lit("needs review")).when(col(verified), F.lit("verified")),
    )


def hardware_text(source, candidate) -> Column:
    """Whether two parts name the same hardware."""
    a, b = blank_to_null(source), blank_to_null(candidate)
    return (
        F.when(a.isNull() & b.isNull(), "No hardware reference on either part")
        .when(a.isNull() | b.isNull(), F.concat(F.lit("Only one part references hardware: "), F.coalesce(a, b)))
        .when(a == b, F.concat(F.lit("Both reference "), a))
        .otherwise(F.concat(F.lit("Hardware differs: "), a, F.lit(" / "), b))
    )


def citation(sheet, document, page, figures=None) -> Column:
    """The sheet (else the document), its page, and the first figure's title (else number)."""
    figure = F.lit(None).cast("string")
    if figures is not None:
        first = F.get(col(figures), F.lit(0))
        figure = F.coalesce(blank_to_null(first["title"]), F.concat(F.lit("Figure "), first["figure_number"].cast("string")))
    return join_present(", ", F.coalesce(blank_to_null(sheet), col(document)), F.concat(F.lit("page "), col(page).cast("string")), figure)


def group_key(*parts: Column | str) -> Column:
    """Parts joined by colons; null counts as empty."""
    return F.concat_ws(":", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


def reasons(first: str, *conditional: tuple[Column, str]) -> Column:
    """A list of reasons: the first always, then each whose condition holds."""
    return F.filter(F.array(F.lit(first), *[F.when(c, F.lit(t)) for c, t in conditional]), lambda x: x.isNotNull())
