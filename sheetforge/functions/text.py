"""Text normalisation and text-building column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the Unicode sense, which \s alone doesn't cover in Java.
WS = r"(?U)\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty strings and null both become null."""
    return F.nullif(col(c), F.lit(""))


def collapse(c: Column | str) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(col(c), WS, " "))


def strip_tags(c: Column | str, spaced: bool = False) -> Column:
    """Markup removed (or replaced by spaces), the common entities resolved, ends trimmed."""
    out = F.regexp_replace(col(c), "<[^>]*>", " " if spaced else "")
    for entity, plain in (("&nbsp;", " "), (" ", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return collapse(out) if spaced else F.trim(out)


def zero_pad(c: Column | str, width: int = 2) -> Column:
    """A number in text padded with zeros, never cut; other text gives null, blank gives null."""
    n = F.try_to_number(F.trim(col(c)), F.lit("999999999")).cast("int").cast("string")
    return F.when(F.length(n) >= width, n).otherwise(F.lpad(n, width, "0"))


def sheet_key(c: Column | str, base: str = "base") -> Column:
    """A sheet number as two digits; `base` passes; blank and non-numeric give null."""
    v = F.lower(F.trim(col(c)))
    return F.when(v == base, F.lit(base)).when(v.rlike(r"^\d{1,9}$"), zero_pad(v))


def document_filter(c: Column | str) -> Column:
    """A document filter as users type it: trimmed, lower case, no leading slash, no leading zeros."""
    v = F.regexp_replace(F.lower(F.trim(col(c))), "^/+", "")
    return F.when(v.rlike(r"^\d{1,9}$"), F.regexp_replace(v, r"^0+(?=\d)", "")).otherwise(v)


def mate_sheets(mates: Column | str) -> Column:
    """Sheet keys of an array of references; text behind the first slash counts, what isn't a number is skipped."""
    after = lambda x: F.trim(F.when(F.instr(x, "/") > 0, F.substring_index(x, "/", -1)))
    keys = F.transform(col(mates), lambda x: sheet_key(F.when(after(x) != "base", after(x))))
    return F.filter(keys, lambda x: x.isNotNull())


def dashes(c: Column | str) -> Column:
    """En and em dashes become hyphens."""
    return F.translate(col(c), "–—", "--")


def snippet(c: Column | str, n: int = 420) -> Column:
    return F.left(collapse(c), F.lit(n))


def chunks(c: Column | str, size: int = 1800) -> Column:
    """array<struct<chunk_index, chunk_text>> of the collapsed text, from 1; empty for empty text."""
    t = F.coalesce(collapse(c), F.lit(""))
    n = F.ceil(F.length(t) / F.lit(size)).cast("int")
    one = lambda i: F.struct(i.alias("chunk_index"), F.substr(t, (i - 1) * size + 1, F.lit(size)).alias("chunk_text"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one)).otherwise(
        F.array().cast("array<struct<chunk_index:int,chunk_text:string>>")
    )


def trailing_index(c: Column | str, sep: str = "-") -> Column:
    """The integer behind the last separator."""
    return F.try_to_number(F.substring_index(col(c), sep, -1), F.lit("999999999")).cast("int")


def join_present(sep: str, *parts: Column) -> Column:
    """Parts that are neither null nor empty, joined; null if there are none."""
    return blank_to_null(F.concat_ws(sep, *[blank_to_null(p) for p in parts]))


def connector_code(gender: Column | str, contact: Column | str, termination: Column | str) -> Column:
    """GENDER_CONTACT_TERMINATION for the four known pairs, else a generic code."""
    g, c = F.upper(F.coalesce(col(gender), F.lit(""))), F.upper(F.coalesce(col(contact), F.lit("")))
    known = g.isin("PLUG", "RECEPTACLE") & c.isin("PIN", "SOCKET")
    return F.when(known, F.concat_ws("_", g, c, F.upper(F.coalesce(blank_to_null(termination), F.lit("CONNECTOR"))))).otherwise("SIGNAL_CONNECTOR")


def connector_name(gender, contact, termination, class_code, cavities) -> Column:
    label = F.when(F.coalesce(col(class_code), F.lit("")) != "", F.concat(F.lit("Class "), col(class_code), F.lit(" "))).otherwise("")
    either = lambda c, d: F.coalesce(blank_to_null(c), F.lit(d))
    return F.trim(
        F.concat(
            F.lit("Micro-D "), either(gender, "Connector"), F.lit(" "), col(cavities).cast("string"), F.lit("-Pin "), label,
            either(termination, "Connector"), F.lit(" ("), either(contact, "Contact"), F.lit(")"),
        )
    )


def connector_description(gender, contact, termination, class_code, material, cavities, finish) -> Column:
    up = lambda c, d=None: F.upper(F.coalesce(blank_to_null(c), F.lit(d)) if d else col(c))
    label = F.when(F.coalesce(col(class_code), F.lit("")) != "", F.concat(F.lit("CLASS "), up(class_code)))
    return join_present(
        ", ", F.lit("MICRO-D"), up(gender, "CONNECTOR"), F.concat(col(cavities).cast("string"), F.lit(" PIN")), label,
        up(termination, "CONNECTOR"), up(material), up(finish), up(contact, "CONTACT"),
    )


def part_number(prefix, insert, components, finish, wire="01", termination=None, hardware=None) -> Column:
    """prefix-insert, then each code whose component is listed and that isn't empty; null without prefix or insert."""

    def gated(name: str, value) -> Column:
        if value is None:
            return F.lit("")
        listed = F.coalesce(F.array_contains(col(components), name), F.lit(False))
        return F.when(listed, F.coalesce(col(value), F.lit(""))).otherwise("")

    ok = (F.coalesce(col(prefix), F.lit("")) != "") & (F.coalesce(col(insert), F.lit("")) != "")
    wire_code = F.lit(wire) if isinstance(wire, str) else wire
    return F.when(
        ok,
        F.concat(
            col(prefix), F.lit("-"), col(insert), gated("wire_type_code", wire_code), gated("termination_length_code", termination),
            gated("shell_finish_code", finish), gated("hardware_code", hardware),
        ),
    )


def termination_style(c: Column | str) -> Column:
    """From a type text."""
    v = F.upper(col(c))
    return F.when(v.contains("SOLDER"), "Solder").when(v.contains("CRIMP"), "Crimp").when(v.contains("PCB") | v.contains("TAIL"), "PCB Tail")


def related_family(c: Column | str) -> Column:
    """The five-digit family named in a reference."""
    return blank_to_null(F.regexp_extract(col(c), r"(\d{5})", 1))


def related_sheet(c: Column | str) -> Column:
    """The sheet named behind the slash of a reference, as two digits."""
    return sheet_key(blank_to_null(F.regexp_extract(col(c), r"/(\d{1,2})", 1)))


def amendment(c: Column | str) -> Column:
    """The number in parentheses of a document id."""
    return blank_to_null(F.regexp_extract(col(c), r"\((\d+)\)", 1))


def spec_sheet(family: Column | str, sheet: Column | str, revision: Column | str, standard: str = "MIL-DTL-") -> Column:
    """STANDARDfamily[/n]revision."""
    n = F.when(F.lower(col(sheet)) != "base", F.concat(F.lit("/"), F.regexp_replace(col(sheet), r"^0+(?=\d)", ""))).otherwise("")
    return F.concat(F.lit(standard), col(family), n, F.coalesce(col(revision), F.lit("")))


def archive_path(path: Column | str, checksum: Column | str) -> Column:
    """archive/name.<first 12 of the checksum>.ext beside the file's folder."""
    stem, ext = F.regexp_replace(col(path), r"\.[^./]*$", ""), F.regexp_extract(col(path), r"(\.[^./]*)$", 1)
    return F.concat(F.lit("archive/"), stem, F.lit("."), F.left(col(checksum), F.lit(12)), ext)


def fact_key(*parts: Column) -> Column:
    """Lower case, all but letters and digits to single underscores, none at the ends."""
    joined = F.lower(F.concat_ws("_", *parts))
    return F.regexp_replace(F.regexp_replace(joined, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def clean_part_number(c: Column | str) -> Column:
    """Upper case without white space, dashes unified, footnote marks behind the wire code dropped."""
    v = dashes(F.regexp_replace(F.upper(col(c)), WS, ""))
    return F.regexp_replace(v, r"(?<=-[A-Z]\d\d)\d+/", "")


def headers(c: Column | str, keywords=("HOW TO ORDER", "DIMENSIONS", "FIGURE", "REQUIREMENTS", "NOTES"), most: int = 20) -> Column:
    """Header lines: 3 to 100 characters, all capitals or with a keyword; the first `most`, then distinct."""
    lines = F.transform(F.split(col(c), "\n"), collapse)

    def is_header(x):
        shape = F.length(x).between(3, 100) & (((F.upper(x) == x) & x.rlike(r"\p{L}")))
        named = F.length(x).between(3, 100) & F.upper(x).rlike("|".join(keywords))
        return shape | named

    return F.array_distinct(F.slice(F.transform(F.filter(lines, is_header), F.upper), 1, most))


def torque_context(c: Column | str) -> Column:
    """The first phrase that occurs decides."""
    v = F.lower(col(c))
    out = F.lit("hardware")
    for phrase in ("mating hardware", "mounting hardware", "mating connector hardware"):
        out = F.when(v.contains(phrase), phrase.replace(" ", "_")).otherwise(out)
    return out


def excerpt(text: Column | str, start: Column, end: Column, n: int = 420) -> Column:
    """The sentence around characters [start, end) (from 0): back to the last full stop that isn't a decimal point, else
    160 characters; forward to the next within 360, else 180 characters; collapsed and cut to n."""
    t = col(text)
    before = F.substr(t, F.lit(1), start)
    cut = F.regexp_extract(before, r"(?s)^.*(?:(?<!\d)\.|\.(?!\d))(.*)$", 1)
    found = before.rlike(r"(?s)(?:(?<!\d)\.|\.(?!\d))")
    left = F.when(found, cut).otherwise(F.right(before, F.lit(160)))
    after = F.substr(t, end + 1, F.lit(361))
    stop = F.regexp_extract(F.left(after, F.lit(360)), r"(?s)^(.*?(?:(?<!\d)\.|\.(?!\d)))", 1)
    right = F.when(stop != "", stop).otherwise(F.left(after, F.lit(180)))
    return snippet(F.concat(left, F.substr(t, start + 1, end - start), right), n)


#: Where a page footer begins that has run into a note.
BLEED = (r"(?i)\s*MIL-DTL-\d{5}/\d+[A-Z]\s+\d+\s*$", r"(?i)\bsupersed\w*\s+page\b", r"(?i)\bdistribution\s+statement\b")


def trim_bleed(c: Column | str, patterns=BLEED) -> Column:
    out = collapse(c)
    for p in patterns:
        out = F.regexp_replace(out, f"(?s){p}.*$", "")
        out = F.regexp_replace(out, r"^[ ,;:-]+|[ ,;:-]+$", "")
    return out


def has_bleed(c: Column | str, patterns=BLEED) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.coalesce(col(c).rlike(p), F.lit(False))
    return out


def pin_block(c: Column | str, begin=r"(?i)Part or Identifying Number|\bM\d{5}/\d{1,2}\s*-", end=r"(?i)\b(?:Referenced documents|CONCLUDING MATERIAL|Amendment notations|Changes from previous issue)\b") -> Column:
    """From the first begin mark to the next end mark; all the text if there is no begin mark."""
    at = F.regexp_instr(col(c), F.lit(begin))
    tail = F.when(at > 0, F.substr(col(c), at)).otherwise(col(c))
    stop = F.regexp_instr(tail, F.lit(end))
    return F.when((at > 0) & (stop > 0), F.substr(tail, F.lit(1), stop - 1)).otherwise(tail)


def spec_header(c: Column | str, family: str = r"\d{5}") -> Column:
    """The first spec number with a revision letter in a first page."""
    return blank_to_null(F.regexp_extract(F.upper(col(c)), rf"\b(MIL-DTL-{family}(?:/\d{{1,2}})?[A-Z])\b", 1))


def revision_letter(c: Column | str) -> Column:
    return blank_to_null(F.upper(F.regexp_extract(col(c), r"(?i)\d([A-Z])(?:\(\d+\))?(?:\s+NOT\s+\d+)?$", 1)))
