"""Facts from page text, all in expressions: tables, lists, notes and attributes.

Pages are rows (doc_key, page_number, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .dims import CAVITIES, CLASS_OF_KEY, CLASS_P, FINISHES
from .relational import first_wins, last_wins, titled_first

_CAVITY = "(?:" + "|".join(map(str, CAVITIES)) + ")"
# Patterns of the documents' notation. They have to accept what they accept for right results.
NUMBER = r"\d+(?:\.\d+)?"
POUNDS = r"(?:inch[- ]?\s*pounds?|in[- ]lbs?|in[- ]lbf)"
PART = r"(M\d{5}/\d{1,2}\s*-\s*[A-Z]\s*(?:\d{2}(?:\s*\d+/)?)?\s*[A-Z](?:\s*[A-Z]\b)?)"
HARDWARE_PART = r"(M\d{5}/05-\d{2}(?:RP)?)"
DIMENSION = r"\b([A-D])\s*[=:]?\s*(\d+\.\d+)\b"
FIGURE = r"(?i)FIGURE\s+(\d+)\.?\s*([^.\n]+)?"
INSERT = r"([A-Z])\s*=\s*(0?9|15|21|25|31|37|51|100)\b"
FINISH = r"(?i)\b([ACKNPT])\s*=\s*[A-Z][A-Z ,()/-]+"
TERMINATION = r"(\d{2})\s*=\s*(\.\d{3})"
HARDWARE_CODE = r"(?i)\b([NPTW])\s*=\s*(no hardware or threaded insert|jackpost and threaded insert|jackpost attach|threaded insert)"
WIRE = r"(?is)(\d{2})\s*=\s*(.*?)(?=\s\d{2}\s*=|\s1/\s+These connectors|$)"
WIRE_BODY = r"^(.*?)\s(0\.5|1\.0|\d{2})(?:\s+inch(?:es)?\s+long)?\s+((?:\d+/[\s,]*)+)(?:\s+(.*))?$"
TORQUE_RANGE = rf"(?i){NUMBER}\s*(?:to|-)\s*{NUMBER}\s*{POUNDS}"
TORQUE_FOR_THREAD = rf"(?i){NUMBER}\s*{POUNDS}\s+for\s+#\d+-\d+(?:\s*\([^)]+\))?"
TORQUE_REFERENCE = r"(?i)(?:mating|mounting)\s+hardware\s+torque\s*:.*?in accordance with\s+MIL-DTL-\d{5}/5"
HARDWARE_REFERENCE = r"(?i)mounting\s+and\s+mating\s+hardware\s*:.*?MIL-DTL-\d{5}/5(?:,\s*configurations?\s*[A-C](?:\s+and\s+[A-C])?)?"
PIN_BEGIN = r"(?i)part or identifying number|\bM83513/\d{1,2}\s*-"
PIN_END = r"(?i)\b(?:referenced documents|concluding material|amendment notations|changes from previous issue)\b"
APART = 3.0
SOLDER_CUP = r"(?i)(?:(\d{2})\s+AWG\s+wire\s+is\s+the\s+maximum\s+wire\s+size[^.]*solder\s+cup|solder\s+cup\s+will\s+accept\s+size\s+(\d{2})\s+AWG\s+maximum)"


def all_groups(text: Column | str, pattern: str, *groups: int, names: tuple[str, ...]) -> Column:
    """array<struct> of capture groups of every match, in order."""
    arrays = [F.regexp_extract_all(t.col(text), F.lit(pattern), F.lit(g)) for g in groups]
    zipped = F.arrays_zip(*[a.alias(f"_{i}") for i, a in enumerate(arrays)])
    return F.transform(zipped, lambda x: F.struct(*[x[f"_{i}"].alias(n) for i, n in enumerate(names)]))


def pages_from_chunks(chunks: DataFrame) -> DataFrame:
    """Page text from (doc_key, page_number, chunk_index, chunk_text), in order."""
    parts = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text")))
    return chunks.groupBy("doc_key", "page_number").agg(F.array_join(F.transform(parts, lambda x: x["chunk_text"]), " ").alias("text"))


def page_chunks(pages: DataFrame, size: int = 1800) -> DataFrame:
    one = pages.select("doc_key", "page_number", F.explode(t.chunks("text", size)).alias("c"))
    chunk_id = F.concat(F.lit("page-"), F.col("page_number"), F.lit("-chunk-"), F.col("c.chunk_index"))
    return one.select("doc_key", "page_number", chunk_id.alias("chunk_id"), "c.chunk_index", "c.chunk_text")


def joined(pages: DataFrame, sep: str = "\n", after: int = 0) -> DataFrame:
    """One text a document, of the pages behind page `after`."""
    parts = F.array_sort(F.collect_list(F.struct("page_number", "text")))
    return pages.where(F.col("page_number") > after).groupBy("doc_key").agg(F.array_join(F.transform(parts, lambda x: x["text"]), sep).alias("text"))


# --- page facts


def example_parts(c: Column | str) -> Column:
    """Part numbers in their accepted form, distinct and sorted."""
    found = F.regexp_extract_all(F.upper(t.dashes(c)), F.lit(PART), F.lit(1))
    hardware = F.regexp_extract_all(F.upper(t.col(c)), F.lit(HARDWARE_PART), F.lit(1))
    clean = F.transform(found, t.clean_part_number)
    ok = F.filter(F.concat(clean, hardware), lambda x: x.rlike(r"^M\d{5}/\d{2}-[A-Z](?:\d{2})?[A-Z]{1,2}$") | x.rlike(r"^M\d{5}/05-\d{2}(?:RP)?$"))
    return F.array_sort(F.array_distinct(ok))


def dimension_hits(c: Column | str) -> Column:
    """map<label, number> of labels A to D followed by a decimal; the first of each label."""
    hits = all_groups(c, DIMENSION, 1, 2, names=("label", "value"))
    of = lambda k: F.get(F.filter(hits, lambda x: x["label"] == k), F.lit(0))
    first = F.filter(F.array(*[of(k) for k in "ABCD"]), lambda x: x.isNotNull())
    return F.map_from_entries(F.transform(first, lambda x: F.struct(x["label"], x["value"].cast("double"))))


def listed(c: Column | str, tokens: list) -> Column:
    """Those tokens that occur as whole words."""
    return F.filter(F.array(*[F.lit(x) for x in tokens]), lambda x: F.rlike(t.col(c), F.concat(F.lit(r"\b"), x.cast("string"), F.lit(r"\b"))))


def cavity_counts(c: Column | str) -> Column:
    return listed(c, CAVITIES)


def finish_codes(c: Column | str) -> Column:
    return listed(c, [k for k, _ in FINISHES])


def references(c: Column | str, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(t.col(c), F.lit(f"({pattern})"), F.lit(1)), F.upper)))


def figure_references(c: Column | str) -> Column:
    found = all_groups(c, FIGURE, 1, 2, names=("number", "title"))
    clean = lambda x: t.blank_to_null(F.regexp_replace(t.collapse(x["title"]), "^[ -]+|[ -]+$", ""))
    return F.transform(found, lambda x: F.struct(x["number"].cast("int").alias("figure_number"), F.concat(F.lit("Figure "), x["number"]).alias("label"), clean(x).alias("title")))


def page_summary(pages: DataFrame, family: str = r"\d{5}") -> DataFrame:
    """One row a page with all that is read from a page alone."""
    return pages.select(
        "doc_key", "page_number", F.length("text").alias("text_length"), t.headers("text").alias("headers"), dimension_hits("text").alias("dimensions"),
        cavity_counts("text").alias("cavity_counts"), example_parts("text").alias("example_parts"), references("text", rf"(?i:MIL-DTL-{family}/\d{{1,2}})").alias("mates_with"),
        references("text", r"(?i:M22759/\d{1,2}-\d{1,2}-\d{1,2})").alias("wire_specs"), figure_references("text").alias("figures"),
    )


def document_lists(summary: DataFrame, hardware_sheet: str = "05") -> DataFrame:
    """Distinct sorted unions of page lists; mates without the document itself and the hardware sheet."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    out = summary.groupBy("doc_key").agg(*[flat(c).alias(c) for c in ("cavity_counts", "example_parts", "mates_with", "wire_specs", "headers")])
    own = t.sheet_key("doc_key")
    return out.withColumn("mates_with", F.filter("mates_with", lambda x: ~t.related_sheet(x).eqNullSafe(own) & (t.related_sheet(x) != hardware_sheet)))


def document_figures(summary: DataFrame) -> DataFrame:
    """The first figure of each number, a titled one before an untitled one."""
    rows = summary.select("doc_key", "page_number", F.posexplode("figures").alias("i", "f")).select("doc_key", "page_number", "i", "f.*")
    return titled_first(rows, ["doc_key", "figure_number"], "title", "page_number", "i").drop("i")


def torque_page(page: Column, c: Column | str, phrases=("/5", "mounting hardware", "torque as required"), number: int = 7) -> Column:
    """Whether a page is the one with the audited tables."""
    out = page == number
    for p in phrases:
        out = out & F.lower(c).contains(p)
    return out


# --- torque


def torque_facts(pages: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Ranges, single values for a thread, references, hardware references, and the audited table on its page.

    The first of rows that agree in all eight fields stays. `table`: (context, thread, scope, low, high).
    """
    p = pages.withColumn("text", F.regexp_replace(t.collapse(t.dashes("text")), r"(?i)\bpound\s+s\b", "pounds"))
    about = F.lower("text").rlike("torque|inch[ -]pound")
    none = lambda kind: F.lit(None).cast(kind)

    def rows(source: DataFrame, branch: int, pattern: str, low, high, thread, scope, applies, keep=None, context=None) -> DataFrame:
        # each match with the text before and behind it, so that its sentence can be cut out
        whole = F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))
        m = source.select("doc_key", "page_number", "text", F.posexplode(whole).alias("i", "m"))
        before = F.slice(F.split("text", pattern, -1), F.lit(1), F.col("i") + 1)  # the pieces before the i-th match
        at = F.length(F.array_join(before, "")) + F.aggregate(F.slice(whole, F.lit(1), F.col("i")), F.lit(0), lambda n, x: n + F.length(x))
        m = m.withColumn("ex", t.excerpt("text", at, at + F.length("m")))
        out = m.select(
            "doc_key", "page_number", F.lit(branch).alias("branch"), "i", (context if context is not None else t.torque_context("ex")).alias("context"), F.col("ex").alias("torque_text"),
            low.alias("min_in_lbf"), high.alias("max_in_lbf"), thread.alias("thread"), scope.alias("scope"), applies.alias("applies_to"),
        )
        return out.where(keep) if keep is not None else out

    get = lambda pattern, g: F.regexp_extract("m", pattern, g)
    span = TORQUE_RANGE
    ranged = rows(p.where(about), 1, span, get(rf"(?i)^({NUMBER})", 1).cast("double"), get(rf"(?i)(?:to|-)\s*({NUMBER})", 1).cast("double"), none("string"), none("string"), F.lit("hardware"), F.lower("torque_text").contains("torque"))
    single = TORQUE_FOR_THREAD
    value = get(rf"^({NUMBER})", 1).cast("double")
    threaded = rows(p.where(about), 2, single, value, value, get(r"(#\d+-\d+)", 1), t.blank_to_null(t.collapse(get(r"\(([^)]+)\)\s*$", 1))), F.lit("hardware"))
    refers = TORQUE_REFERENCE
    reference = rows(p.where(about), 3, refers, none("double"), none("double"), none("string"), none("string"), F.upper(get(r"(?i)(MIL-DTL-\d{5}/5)", 1)))
    names = HARDWARE_REFERENCE
    hardware = rows(p.where(~F.col("text").rlike(refers)), 0, names, none("double"), none("double"), none("string"), none("string"), F.upper(get(r"(?i)(MIL-DTL-\d{5}/5)", 1)), context=F.lit("hardware_reference"))
    hardware = first_wins(hardware, ["doc_key", "page_number"], "i")
    out = hardware.unionByName(ranged).unionByName(threaded).unionByName(reference)
    if table is not None:
        on_page = p.where(about & torque_page(F.col("page_number"), "text")).crossJoin(F.broadcast(table))  # a few fixed rows
        label = F.concat_ws(" ", "context", "thread", "scope", F.concat("low", F.lit("-"), "high"))
        out = out.unionByName(
            on_page.select("doc_key", "page_number", F.lit(4).alias("branch"), F.lit(0).alias("i"), "context", label.alias("torque_text"), F.col("low").alias("min_in_lbf"), F.col("high").alias("max_in_lbf"), "thread", "scope", F.lit("hardware sheet").alias("applies_to"))
        )
    return first_wins(out, ["doc_key", "page_number", "context", "torque_text", "min_in_lbf", "max_in_lbf", "thread", "scope", "applies_to"], "branch", "i")


# --- tables


def _decimal(x: Column) -> Column:
    """A decimal token; four digits count as .dddd; else null."""
    return F.when(x.rlike(r"^\d*\.\d+$"), x).when(x.rlike(r"^\d{4}$"), F.concat(F.lit("."), x))


def _default_shell(n: Column) -> Column:
    return F.when(n == 51, "B").when(n == 100, "C").otherwise("A")


def lines(pages: DataFrame) -> DataFrame:
    out = pages.select("doc_key", "page_number", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"))
    return out.withColumn("line", t.collapse("line")).where("line != ''").withColumn("tokens", F.split("line", " "))


def _dimensions(decimals: Column) -> Column:
    """A is the first decimal; B, C and D are the next three, sorted."""
    rest = F.array_sort(F.transform(F.slice(decimals, 2, 3), lambda x: x.cast("double")))
    return F.create_map(F.lit("A"), decimals[0].cast("double"), F.lit("B"), rest[0], F.lit("C"), rest[1], F.lit("D"), rest[2])


def geometry_rows(pages: DataFrame) -> DataFrame:
    """(doc_key, page_number, cavity_count, shell_letter, dimensions, ordinal) from table lines and from the token stream.

    A line counts if it begins with a cavity count and has four decimals; in the stream, four decimals have to be among
    the seven tokens behind a cavity count. The last row of each (cavity_count, shell_letter) stays.
    """
    is_cavity = lambda x: F.regexp_replace(x, r"\.+$", "").rlike(f"^{_CAVITY}$")
    decimals = lambda a: F.filter(F.transform(a, _decimal), lambda x: x.isNotNull())
    ln = lines(pages).where(is_cavity(F.col("tokens")[0])).withColumn("d", decimals(F.slice("tokens", F.lit(2), F.size("tokens")))).where(F.size("d") >= 4)
    n = F.regexp_replace(F.col("tokens")[0], r"\.+$", "").cast("int")
    letter = F.get(F.filter(F.slice("tokens", F.lit(2), F.size("tokens")), lambda x: x.rlike("^[A-Z]$")), F.lit(0))
    by_line = ln.select("doc_key", "page_number", F.lit(0).alias("branch"), F.col("line_no").alias("place"), n.alias("cavity_count"), F.coalesce(letter, _default_shell(n)).alias("shell_letter"), _dimensions(F.col("d")).alias("dimensions"))
    stream = pages.withColumn("tokens", F.split(t.collapse("text"), " "))
    hit = F.filter(F.transform("tokens", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: is_cavity(s["x"]))
    st = stream.select("doc_key", "page_number", "tokens", F.explode(hit).alias("h"))
    st = st.withColumn("d", F.slice(decimals(F.slice("tokens", F.col("h.i") + 2, 7)), 1, 4)).where(F.size("d") == 4)
    m = F.regexp_replace("h.x", r"\.+$", "").cast("int")
    by_stream = st.select("doc_key", "page_number", F.lit(1).alias("branch"), F.col("h.i").alias("place"), m.alias("cavity_count"), _default_shell(m).alias("shell_letter"), _dimensions(F.col("d")).alias("dimensions"))
    every = by_line.unionByName(by_stream).withColumn("ordinal", F.struct("page_number", "branch", "place"))
    return last_wins(every, ["doc_key", "cavity_count", "shell_letter"], "ordinal").drop("branch", "place")


def _labels(header: Column) -> Column:
    """The labels of a board-mount table's columns, from the words of its header; null if it isn't one."""
    head = F.upper(F.regexp_replace(header, rf"(?s)(?:^|\s){_CAVITY}\s+\d*\.\d+.*$", ""))
    has = lambda k: head.rlike(rf"\b{k}\b")
    labels = lambda s: F.array(*[F.lit(c) for c in s])
    table = head.contains("NUMBER") & head.contains("CONTACT")
    return F.when(
        table,
        F.when(has("H"), labels("ABDEFGH")).when(has("F") & has("G"), labels("ABCDEFG")).when(has("E"), labels("ABCDE")).when(has("C"), labels("ABCD")).when(has("D"), labels("ABD")),
    )


def pcb_rows(pages: DataFrame, valid: list[int] | None = None) -> DataFrame:
    """Rows of board-mount tables. A header may run over six lines; the last labels found hold until others are.

    The last row of each cavity count stays.
    """
    w = Window.partitionBy("doc_key", "page_number").orderBy("line_no")
    ln = lines(pages)
    header = F.array_join(F.collect_list("line").over(w.rowsBetween(-5, 0)), " ")
    ln = ln.withColumn("own", _labels(header)).withColumn("labels", F.last("own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("labels is not null")
    hits = F.filter(F.transform("tokens", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(f"^{_CAVITY}$"))
    r = ln.select("doc_key", "page_number", "line_no", "labels", "tokens", F.explode(hits).alias("h"))
    plain = F.transform(F.slice("tokens", F.col("h.i") + 2, F.size("tokens")), lambda x: F.regexp_replace(x, "^[,;]+|[,;]+$", ""))
    r = r.withColumn("d", F.filter(plain, lambda x: x.rlike(r"^\d*\.\d+$"))).where(F.size("d") >= F.size("labels"))
    r = r.withColumn("cavity_count", F.col("h.x").cast("int"))
    if valid:
        r = r.where(F.col("cavity_count").isin(valid))
    values = F.transform(F.expr("slice(d, 1, size(labels))"), lambda x: x.cast("double"))
    r = r.select("doc_key", "page_number", "cavity_count", F.lit(None).cast("string").alias("shell_letter"), F.map_from_arrays("labels", values).alias("dimensions"), F.struct("page_number", "line_no", F.col("h.i").alias("i")).alias("ordinal"))
    return last_wins(r, ["doc_key", "cavity_count"], "ordinal")


def with_synthesized(rows: DataFrame, inserts: DataFrame) -> DataFrame:
    """For documents without parsed rows, a row without dimensions for each cavity count of their inserts."""
    bare = inserts.select("doc_key", "cavity_count").distinct().join(rows.select("doc_key").distinct(), "doc_key", "left_anti")
    return rows.drop("ordinal").unionByName(
        bare.select("doc_key", F.lit(1).alias("page_number"), "cavity_count", _default_shell(F.col("cavity_count")).alias("shell_letter"), F.create_map().cast("map<string,double>").alias("dimensions"))
    )


# --- part-number block


def insert_map(pin: Column | str) -> Column:
    """Inserts with their cavity counts in order of appearance; the first of each letter."""
    found = all_groups(pin, INSERT, 1, 2, names=("code", "n"))
    first = F.filter(F.transform(found, lambda x, i: F.struct(x["code"].alias("insert_arrangement"), x["n"].cast("int").alias("cavity_count"), i.alias("i"))),
                     lambda x: F.array_position(F.transform(found, lambda y: y["code"]), x["insert_arrangement"]) == x["i"] + 1)
    return F.transform(first, lambda x: F.struct(x["insert_arrangement"], x["cavity_count"]))


def finish_map(pin: Column | str) -> Column:
    """Known finishes in order of appearance with their usual description; the first of each code."""
    codes = F.array_distinct(F.transform(F.regexp_extract_all(t.col(pin), F.lit(FINISH), F.lit(1)), F.upper))
    usual = F.create_map(*[F.lit(x) for pair in FINISHES for x in pair])
    return F.transform(codes, lambda c: F.struct(c.alias("code"), usual[c].alias("description")))


def termination_options(c: Column | str) -> Column:
    found = all_groups(c, TERMINATION, 1, 2, names=("code", "length"))
    return F.transform(found, lambda x: F.struct(x["code"], x["length"].cast("double").alias("length_inches")))


def hardware_codes(c: Column | str) -> Column:
    found = all_groups(c, HARDWARE_CODE, 1, 2, names=("code", "description"))
    return F.transform(found, lambda x: F.struct(F.upper(x["code"]).alias("code"), t.collapse(x["description"]).alias("description")))


def arrangement_notes(c: Column | str) -> Column:
    """map of notes on inserts H, J and K that mention 100, a shroud or a flange."""
    ends = {"H": r"(?=Insert\s+arrangement\s+[JK]|$)", "J": r"(?=Insert\s+arrangement\s+K|$)", "K": r"(?=\d+/\s|$)"}
    notes = [F.struct(F.lit(k).alias("k"), t.snippet(F.regexp_extract(t.col(c), rf"(?is)(Insert\s+arrangement\s+{k}.*?){e}", 1), 360).alias("v")) for k, e in ends.items()]
    return F.map_from_entries(F.filter(F.array(*notes), lambda x: (x["v"] != "") & F.lower(x["v"]).rlike("100|shroud|flange")))


def document_class(key: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CLASS_OF_KEY.items() for x in pair])
    return F.coalesce(known[t.document_filter(key)], F.lit("pcb"))


def pin_components(pages: DataFrame, finishes: list[tuple[str, str]] = FINISHES, code: str = "M83513") -> DataFrame:
    """Prefix, components, inserts and finishes of each document by its class."""
    d = joined(pages).withColumn("class", document_class("doc_key")).withColumn("sheet", t.sheet_key("doc_key"))
    pin = t.pin_block("text")
    every = F.array(*[F.struct(F.lit(k).alias("code"), F.lit(v).alias("description")) for k, v in finishes])
    header = F.regexp_extract("text", r"(?i)M\d{5}/\d{1,2}\s*-\s*[A-Z]\s*(\d{2})", 1)
    names = lambda *x: F.array(*[F.lit(v) for v in x])
    p = F.col("sheet").isin(CLASS_P)
    base, hardware, pcb = F.col("class") == "base_spec", F.col("class") == "hardware", F.col("class") == "pcb"
    none = F.array().cast("array<struct<code:string,description:string>>")
    found = finish_map(pin)
    components = (
        F.when(base, F.array().cast("array<string>"))
        .when(hardware, names("dash_number", "optional_rp_suffix"))
        .when(p & (F.col("class") == "crimp_p"), names("insert_arrangement", "wire_type_code"))
        .when(p, names("insert_arrangement"))
        .when(pcb, names("insert_arrangement", "termination_length_code", "shell_finish_code", "hardware_code"))
        .when(header != "", names("insert_arrangement", "wire_type_code", "shell_finish_code"))
        .otherwise(names("insert_arrangement", "shell_finish_code"))
    )
    return d.select(
        "doc_key", "class", F.when(base, F.lit(code)).otherwise(F.concat(F.lit(f"{code}/"), "sheet")).alias("prefix"), components.alias("components"),
        F.when(base | hardware, F.array().cast("array<struct<insert_arrangement:string,cavity_count:int>>")).otherwise(insert_map(pin)).alias("insert_arrangements"),
        F.when(base, every).when(hardware | p, none).when(pcb & (F.size(found) == 0), every).otherwise(found).alias("finishes"),
        F.when(pcb, termination_options("text")).alias("termination_options"), F.when(pcb, hardware_codes("text")).alias("hardware_options"), arrangement_notes("text").alias("arrangement_notes"),
    )


# --- wires and notes


def wire_notes(c: Column | str) -> Column:
    """map<number, note> of notes `n/ text` from the marker note to the end; a later note of a number replaces an earlier one."""
    begin = F.regexp_instr(t.col(c), F.lit(r"(?i)1/\s+These connectors"))
    body = F.when(begin > 0, F.substr(t.col(c), begin)).otherwise(t.col(c))
    parts = F.filter(F.split(body, r"(?:^|\s)(?=\d{1,2}/\s)"), lambda x: F.trim(x).rlike(r"^\d{1,2}/\s"))
    pairs = F.transform(parts, lambda x: F.struct(F.regexp_extract(F.trim(x), r"^(\d{1,2})/", 1).alias("k"), t.trim_bleed(F.regexp_replace(F.trim(x), r"^\d{1,2}/\s*", "")).alias("v")))
    last = F.filter(F.transform(pairs, lambda x, i: F.struct(x["k"].alias("k"), x["v"].alias("v"), i.alias("i"))), lambda x: ~F.exists(F.slice(pairs, x["i"] + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))


def wire_options(pages: DataFrame, after: int = 5) -> DataFrame:
    """(doc_key, wire_code, wire_spec, length_in, note_refs, note_texts, space_approved) from the pages behind page `after`.

    Rows without a length are dropped, unknown notes too; the last row of a code stays.
    """
    d = joined(pages, " ", after).withColumn("notes", wire_notes("text"))
    rows = all_groups("text", WIRE, 1, 2, names=("code", "body"))
    r = d.select("doc_key", "notes", F.posexplode(rows).alias("i", "w"))
    body = F.trim(F.regexp_replace(t.collapse("w.body"), r"(?:See notes at end of wire type|These connectors have leads attached).*$", ""))
    shape = WIRE_BODY
    r = r.withColumn("body", body).where(F.col("body").rlike(shape))
    spec = F.concat_ws(" ", t.blank_to_null(F.regexp_extract("body", shape, 1)), t.blank_to_null(F.regexp_extract("body", shape, 4)))
    spec = F.regexp_replace(t.collapse(F.regexp_replace(spec, rf"\b[A-Z]\s*=\s*{_CAVITY}\b", "")), "^[ ,;]+|[ ,;]+$", "")
    refs = F.regexp_extract_all(F.regexp_extract("body", shape, 3), F.lit(r"(\d+)/"), F.lit(1))
    r = r.withColumn("note_refs", refs).withColumn("note_texts", F.filter(F.transform("note_refs", lambda k: F.try_element_at("notes", k)), lambda x: x.isNotNull()))
    out = r.select(
        "doc_key", F.col("w.code").alias("wire_code"), spec.alias("wire_spec"), F.regexp_extract("body", shape, 2).cast("double").alias("length_in"), "note_refs", "note_texts",
        F.exists("note_texts", lambda x: F.lower(x).contains("space applications")).alias("space_approved"), "i",
    )
    return last_wins(out, ["doc_key", "wire_code"], "i").drop("i")


def solder_cup_limit(c: Column | str) -> Column:
    """The largest gauge a solder cup takes, if the page says so."""
    limit = SOLDER_CUP
    return F.coalesce(t.blank_to_null(F.regexp_extract(t.collapse(c), limit, 1)), t.blank_to_null(F.regexp_extract(t.collapse(c), limit, 2))).cast("int")


def connector_notes(c: Column | str) -> Column:
    reverse = t.blank_to_null(t.snippet(F.regexp_extract(t.col(c), r"(?is)(reverse\s+gender\s+contact.*?interface\.?)", 1), 360))
    seal = t.blank_to_null(t.snippet(F.regexp_extract(t.col(c), r"(?i)interfacial\s+seal\s*:\s*(.*?)(?:\.|\n)", 1)))
    return F.struct(reverse.alias("reverse_gender_contact"), seal.alias("interfacial_seal"))


def hardware_scopes(c: Column | str) -> Column:
    """Configuration scopes of the hardware sheet that a document names; null if it doesn't refer to the sheet."""
    ab = F.when(t.col(c).rlike(r"(?i)arrangements?\s+A\s+through\s+G"), "A/B")
    hc = F.when(t.col(c).rlike(r"(?i)arrangements?\s+[HJK]\b|100\s+cavity|configuration\s+C\b"), "C")
    return F.when(t.col(c).rlike(r"MIL-DTL-\d{5}/5\b"), F.array_compact(F.array(ab, hc)))


def hardware_details(documents: DataFrame, options: DataFrame, text_column: str = "text") -> DataFrame:
    """Hardware options that apply to each document: those of the scopes it names. Options are a few fixed rows."""
    d = documents.select("doc_key", F.explode(hardware_scopes(text_column)).alias("scope"))
    return d.join(F.broadcast(options), "scope")


def mentioned_options(documents: DataFrame, options: DataFrame, prefix: str, text_column: str = "text") -> DataFrame:
    """Options whose part number stands in the document; all of them for a document that names none."""
    pairs = documents.crossJoin(F.broadcast(options))  # a few fixed rows
    pin = F.concat(F.lit(f"{prefix}-"), "dash")
    named = pairs.withColumn("named", F.col(text_column).contains(pin) | F.col(text_column).contains(F.concat(F.lit(f"{prefix} - "), "dash")))
    some = F.max("named").over(Window.partitionBy("doc_key"))
    return named.withColumn("some", some).where("named or not some").select("doc_key", "dash", pin.alias("pin"))


def attributes(title: Column | str, joined_text: Column | str) -> dict[str, Column]:
    """Attributes by keywords of the title; the first of each pair wins."""
    u = F.upper(title)
    either = lambda *pairs: _first(u, pairs)
    amps = F.regexp_extract(t.col(joined_text), rf"(?i)current rating, maximum:\s*({NUMBER})\s*amperes per contact", 1)
    return {
        "shell_material": either(("CLASS M", "Metal"), ("CLASS P", "Plastic")),
        "class": either(("CLASS M", "M"), ("CLASS P", "P")),
        "gender": either(("PLUG", "Plug"), ("RECEPTACLE", "Receptacle")),
        "contact_type": either(("PIN CONTACTS", "Pin"), ("SOCKET CONTACTS", "Socket")),
        "termination_style": either(("SOLDER TYPE", "Solder"), ("CRIMP TYPE", "Crimp")),
        "board_mount_style": either(("RIGHT ANGLE", "Right Angle"), ("STRAIGHT", "Straight")),
        "profile": either(("NARROW PROFILE", "Narrow"), ("STANDARD PROFILE", "Standard")),
        "row_count": t.blank_to_null(F.regexp_extract(u, r"\b([234])\s+ROW\b", 1)).cast("int"),
        "current_rating": t.blank_to_null(amps).cast("double"),
        "polarization": F.lit("Standard polarized shell"),
        "hardware_ref": t.blank_to_null(F.regexp_extract(t.col(joined_text), r"(MIL-DTL-\d{5}/5)\b", 1)),
    }


def _first(u: Column, pairs) -> Column:
    out = F.lit(None).cast("string")
    for word, value in reversed(pairs):
        out = F.when(u.contains(word), value).otherwise(out)
    return out


def truthy_json(**fields: Column) -> Column:
    """A JSON object of the fields that aren't null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def _lines(words: Column) -> Column:
    """array<string>: lines of array<struct<top, x0, word>>. In order of the rounded top and x0, a word more than APART below the
    line's first word begins a new line; a line reads from left to right. A fold, as each line's anchor is its first word."""
    ordered = F.array_sort(F.transform(words, lambda w: F.struct(F.round(w["top"], 1).alias("t"), w["x0"].alias("x0"), w["top"].alias("top"), w["word"].alias("word"))))
    zero = F.array().cast("array<struct<anchor:double,words:array<struct<x0:double,n:int,word:string>>>>")

    def step(acc, w):
        last = F.element_at(acc, -1)
        placed = lambda n: F.array(F.struct(w["x0"].cast("double").alias("x0"), n.cast("int").alias("n"), w["word"].alias("word")))
        fresh = F.concat(acc, F.array(F.struct(w["top"].cast("double").alias("anchor"), placed(F.lit(0)).alias("words"))))
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["anchor"].alias("anchor"), F.concat(last["words"], placed(F.size(last["words"]))).alias("words"))))
        return F.when(F.size(acc) == 0, fresh).when(F.abs(w["top"] - last["anchor"]) > APART, fresh).otherwise(grown)

    shown = lambda line: F.array_join(F.transform(F.array_sort(line["words"]), lambda x: x["word"]), " ")
    return F.aggregate(ordered, zero, step, lambda acc: F.transform(acc, shown))


def word_lines(words: DataFrame) -> DataFrame:
    """(doc_key, page_number, line_no, line) of (doc_key, page_number, word, top, x0)."""
    folded = words.groupBy("doc_key", "page_number").agg(_lines(F.collect_list(F.struct("top", "x0", "word"))).alias("lines"))
    return folded.select("doc_key", "page_number", F.posexplode("lines").alias("line_no", "line"))


def block(lines_: Column | str, begin: str, end: str, most: int = 90) -> Column:
    """Lines from the first that matches `begin`, at most `most`, before the first later one that matches `end`."""
    c = t.col(lines_)
    at = F.array_position(F.transform(c, lambda x: x.rlike(begin)), True)
    tail = F.slice(c, F.greatest(at, F.lit(1)), most)
    stop = F.array_position(F.transform(F.slice(tail, 2, most), lambda x: x.rlike(end)), True)
    return F.when(at == 0, F.array().cast("array<string>")).when(stop > 0, F.slice(tail, F.lit(1), stop)).otherwise(tail)


def with_pin_block(pages: DataFrame, words: str, columns: list[str], text: str = "text") -> DataFrame:
    """The columns of pages (`words`: array<struct<word, top, x0>>); a part-number block that the words give and the text doesn't
    have goes to the text's end under a heading. Null or empty words change nothing."""
    lines = _lines(F.coalesce(words, F.array().cast("array<struct<word:string,top:double,x0:double>>")))
    found = F.array_join(block("_lines", PIN_BEGIN, PIN_END), "\n")
    rows = pages.withColumn("_lines", lines).withColumn("_block", found)
    more = (F.col("_block") != "") & ~F.contains(F.coalesce(text, F.lit("")), F.col("_block"))
    whole = F.when(more, F.concat(F.coalesce(text, F.lit("")), F.lit("\nWORD-LEVEL PIN BLOCK:\n"), F.col("_block"))).otherwise(F.col(text))
    return rows.select(*[whole.alias(c) if c == text else F.col(c) for c in columns])
