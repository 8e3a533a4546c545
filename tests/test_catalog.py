"""Facts about parsing, variants, torque, gates and releases on small fixtures."""

import uuid

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetforge.functions import text as t
from sheetforge.functions import values as v
from sheetforge.operators import dims, extract, quality, search, torque, variants
from sheetforge.operators import relational as r
from sheetforge.plans import release, views
from sheetforge.queries.joins import _no_shapes, _records
from sheetforge.sources import pdf, store, tables, web
from sheetforge.streaming import events


def pages(spark, *texts, key="10"):
    return spark.createDataFrame([(key, i, x) for i, x in enumerate(texts, 1)], "doc_key string, page_number int, text string")


@pytest.mark.parametrize(
    "text, labels, cavities",
    [
        ("NUMBER OF CONTACTS A B D\n9 .785 .400 .308\n15 .935 .550 .308", "ABD", [9, 15]),
        ("NUMBER OF CONTACTS A B C D\n9 .785 .400 .308 .185", "ABCD", [9]),
        ("NUMBER\nOF\nCONTACTS A B D\n9 .785 .400 .308\n21 1.0 .7 .308", "ABD", [9, 21]),
        ("NUMBER OF CONTACTS A B C D E\n9 .785 .400 .308 .185 .1", "ABCDE", [9]),
        ("NUMBER OF CONTACTS A B D E F G H\n51 1.4 1.2 .3 .2 .1 .4 .5", "ABDEFGH", [51]),
        ("NUMBER OF CONTACTS A B C D E F G\n100 1.4 1.2 .3 .2 .1 .4 .5", "ABCDEFG", [100]),
    ],
)
def test_board_tables(spark, text, labels, cavities):
    rows = extract.pcb_rows(pages(spark, text)).orderBy("cavity_count").collect()
    assert [x["cavity_count"] for x in rows] == cavities
    assert all("".join(sorted(x["dimensions"])) == labels for x in rows)


def test_board_table_needs_a_header(spark):
    assert extract.pcb_rows(pages(spark, "9 .785 .400 .308")).count() == 0
    assert extract.pcb_rows(pages(spark, "NUMBER OF CONTACTS A B D\n9 .785 .400 .308"), valid=[15]).count() == 0


def pin(spark, key, text):
    return extract.pin_components(pages(spark, text, key=key)).first()


def test_part_number_blocks(spark):
    listed = " ".join(f"{c} = {n}" for c, n in zip("ABCDEFGHJK", [9, 15, 21, 25, 31, 37, 51, 100, 100, 100], strict=True))
    x = pin(spark, "2", f"Part or Identifying Number (PIN): M83513/02-A N {listed}\nA = Aluminum\nC = Cadmium\nk = zinc\nN = Nickel\nP = Passivated\nT = Polymer\nReferenced documents Z = 9")
    assert "".join(i["insert_arrangement"] for i in x["insert_arrangements"]) == "ABCDEFGHJK"
    assert "".join(f["code"] for f in x["finishes"]) == "ACKNPT"
    assert x["finishes"][0]["description"] == "Pure electrodeposited aluminum"
    x = pin(spark, "4", f"PIN M83513/04-A 01 1/ N {listed}")
    assert len(x["insert_arrangements"]) == 10 and "wire_type_code" in x["components"]
    x = pin(spark, "7", f"Part or Identifying Number: M83513/07-A {listed[:47]} C = Cadmium")
    assert len(x["insert_arrangements"]) == 7 and x["finishes"] == [] and x["components"] == ["insert_arrangement"]
    x = pin(spark, "base", "anything")
    assert len(x["finishes"]) == 6 and x["prefix"] == "M83513"


def test_variant_counts(spark):
    c = variants.configurations(_records(spark), _no_shapes(spark))
    assert {x["slash_sheet"]: x["count"] for x in c.groupBy("slash_sheet").count().collect()} == dims.CONFIG_COUNTS
    assert c.where(F.col("slash_sheet").isin(dims.CLASS_P) & F.col("finish_code").isNotNull()).count() == 0
    ids = variants.staged_id(c)
    assert ids.select("config_id").distinct().count() == c.count()


def test_geometry_reaches_variants(spark):
    shapes = extract.geometry_rows(pages(spark, "9 A .785 .408 .300 .299", key="1")).select("doc_key", "page_number", "cavity_count", "shell_letter", "dimensions", F.lit(1).alias("ordinal"))
    x = variants.configurations(_records(spark), shapes).where("slash_sheet = '01' and cavity_count = 9").first()
    assert x["shell_letter"] == "A" and x["dimensions"]["B"] == 0.299 and x["source_page"] == 1


def check_frame(spark, **change):
    base = {
        "document_type": "plug_receptacle", "cavity_counts": [9], "n_configs": 8, "empty_cavities": [], "inserts": list("ABCDEFGHJK"), "finishes": list("ACKNPT"), "wire_codes": [], "bleed_codes": [],
        "expected_cavities": [9], "min_configs": 8, "min_inserts": 8, "min_wires": 0, "expected_inserts": list("ABCDEFGHJK"), "expected_finishes": list("ACKNPT"),
        "present": ["spec_sheet", "configuration_rows", "pin_components", "figure_references"], "required": ["spec_sheet"], "expected_headers": ["FIGURE"], "headers": ["FIGURE 1"], "n_pages": 3,
    } | change
    kinds = ", ".join(f"{k} {'string' if isinstance(x, str) else 'int' if isinstance(x, int) else 'array<int>' if 'cavit' in k else 'array<string>'}" for k, x in base.items())
    return spark.createDataFrame([tuple(base.values())], kinds)


def test_checks_and_confidence(spark):
    x = quality.confidence(quality.validation_checks(check_frame(spark))).first()
    assert x["flags"] == [] and x["confidence"] == 1.0 and not x["needs_fallback"]
    x = quality.validation_checks(check_frame(spark, inserts=list("ABCDEFGH"))).first()
    assert x["flags"] == ["unexpected_insert_arrangements"]
    assert [c["details"] for c in x["checks"] if c["status"] == "fail"] == ["missing=J,K extra="]
    x = quality.validation_checks(check_frame(spark, document_type="pcb_tail", empty_cavities=[9])).first()
    assert x["flags"] == ["empty_configuration_dimensions"]
    x = quality.confidence(quality.validation_checks(check_frame(spark, wire_codes=["01", "03"], min_wires=18, headers=[], required=["spec_sheet", "title"]))).first()
    assert x["flags"] == ["too_few_wire_options", "wire_code_gaps"]
    assert x["score"] == pytest.approx(1 - 0.12 - 0.08 - 0.10 - 0.03) and x["needs_fallback"]


def golden(spark):
    """Variants of sheets 1 to 4, with their mates."""
    mates = {"01": ["2", "4"], "02": ["1", "3"], "03": ["2", "4"], "04": ["1", "3"]}
    c = variants.staged_id(variants.configurations(_records(spark), _no_shapes(spark))).where(F.col("slash_sheet").isin(list(mates)))
    m = spark.createDataFrame([(k, [f"MIL-DTL-83513/{x}" for x in s] + ["MIL-DTL-83513/2H"]) for k, s in mates.items()], "slash_sheet string, m array<string>")
    return c.drop("mates_with").join(m, "slash_sheet").withColumnRenamed("m", "mates_with")


def test_golden_mates(spark):
    c = golden(spark)
    src = c.where("finish_code = 'A' and insert_code in ('A', 'B', 'G')")
    valid = F.when(F.col("slash_sheet").isin("01", "03"), F.array(F.lit("02"), F.lit("04"))).otherwise(F.array(F.lit("01"), F.lit("03")))
    never = F.when(F.col("slash_sheet").isin("01", "03"), F.array(F.lit("01"), F.lit("03"), F.lit("05"))).otherwise(F.array(F.lit("02"), F.lit("04"), F.lit("05")))
    cases = src.select(F.col("config_id").alias("case_id"), valid.alias("valid"), never.alias("invalid"))
    got = search.mate_families(src, c).select(F.col("source_config_id").alias("case_id"), F.split("family_key", ":")[0].alias("slash_sheet"))
    out = quality.golden_verdicts(cases, got)
    assert {(x["verdict"], x["n"]) for x in quality.verdict_summary(out).collect()} == {("pass", 12)}
    lost = quality.golden_verdicts(cases, got.limit(0)).first()
    assert lost["verdict"] == "unresolved" and lost["got"] == []


def test_mates_rank_and_reasons(spark):
    c = golden(spark)
    one = c.where("slash_sheet = '01' and insert_code = 'A' and finish_code = 'A'").first()["config_id"]
    rows = search.mates_raw(c, one).collect()
    assert [x["place"] for x in rows] == list(range(1, len(rows) + 1)) and rows[0]["reasons"][:2] == ["Listed as a mating sheet", "Same cavity count"]
    assert {x["family_key"].split(":")[0] for x in search.mates_grouped(c, one).collect()} == {"02", "04"}
    assert search.mates_raw(c.withColumn("cavity_count", F.lit(None).cast("int")), one).count() == 0


def test_search(spark):
    c = golden(spark)
    assert search.search_raw(c, slash_sheet="2", finish_code="a", limit=5).first()["total"] == 10
    assert search.search_raw(c, gender="PLUG", limit=1).first()["total"] == 96
    assert search.search_raw(c, query="100%", limit=5).count() == 0
    g = search.search_grouped(c, slash_sheet="02", query="micro-d", limit=3)
    assert [x["n_variants"] for x in g.collect()] == [18, 6, 6] and g.first()["total"] == 8
    for bad in ({"limit": 0}, {"limit": 101}, {"offset": -1}, {"shell_letter": "AB"}):
        with pytest.raises(ValueError):
            search.search_raw(c, **bad)


def test_part_detail(spark):
    c = golden(spark).withColumn("attributes", F.lit('{"hardware_options":[{"code":"N","description":"none"},{"x":1}]}'))
    one = c.where("slash_sheet = '02'").first()["config_id"]
    wires = spark.createDataFrame([(one, "01", "w")], "config_id string, wire_code string, wire_spec string")
    facts = spark.createDataFrame([("other", "x")], "spec_sheet string, torque_text string")
    raw = spark.createDataFrame([("02", "own"), ("05", "main")], "slash_sheet string, torque_text string")
    x = search.part_detail(c, wires, facts, raw, one).first()
    assert x["torque"] == ["own"] and [w["wire_code"] for w in x["wires"]] == ["01"] and [o["code"] for o in x["hardware_options"]] == ["N"]
    assert search.part_detail(c, wires, facts, raw, "unknown").count() == 0


def torque_tables(spark):
    docs = spark.createDataFrame([(f"S{n}", "base" if n == 0 else f"{n:02d}") for n in range(34)], "spec_sheet string, slash_sheet string")
    rows = [("S5", "mounting_torque" if i < 3 else "mating_torque", th, sc, lo, hi, i, "2020") for i, (_, th, sc, lo, hi) in enumerate(dims.TORQUE_TABLE)]
    rows += [("S10", "hardware", None, None, 1.0, 2.0, 7, "2020"), ("S11", "hardware", None, None, 1.0, 2.0, 8, "2021"), ("S12", "hardware", None, None, 3.0, 4.0, 9, "2021"), ("S8", "hardware", None, None, 2.0, 3.0, 10, "2022"), ("S1", "reference", None, None, None, None, 11, "2022")]
    return docs, spark.createDataFrame(rows, "spec_sheet string, context string, thread string, scope string, min_in_lbf double, max_in_lbf double, ordinal int, extracted_at string")


def test_torque_model(spark):
    docs, rows = torque_tables(spark)
    status = torque.classify(docs, rows, dims.profile_rules(spark))
    modes = {x["slash_sheet"]: (x["torque_mode"], x["audit_status"]) for x in status.collect()}
    assert modes["05"] == ("owns_profile", "verified") and modes["08"] == ("needs_review", "needs_review") and modes["base"] == ("none", "pending") and modes["20"] == ("uses_shared_profile", "pending")
    facts = torque.profile_values(rows, status).withColumn("profile_id", F.col("profile_code"))
    assert {x["profile_id"]: x["count"] for x in facts.groupBy("profile_id").count().collect()} == {dims.MAIN: 6, dims.PCB: 2, dims.PROVISIONAL: 1}
    profiles = spark.createDataFrame([(c, k, lv, s, a, f"S{int(g)}", True) for c, k, lv, s, a, g in dims.PROFILES], "profile_id string, kind string, truth_level string, profile_status string, approval_status string, source_spec_sheet string, is_active boolean")
    mapping = status.where("profile_code is not null").select("spec_sheet", F.col("profile_code").alias("profile_id"), "mapping_type")
    resolved = {d: {x["spec_sheet"]: x for x in torque.resolve(status.select("spec_sheet", "torque_mode", "audit_status"), mapping, profiles, facts, rows, d).collect()} for d in ("view", "staged", "release")}
    x = resolved["view"]
    assert x["S2"]["fact_count"] == 6 and x["S2"]["values_inherited"] and x["S2"]["values_verified"] and not x["S2"]["needs_review"]
    assert not x["S5"]["values_inherited"] and x["S20"]["needs_review"] and x["S20"]["values_inherited"] and not x["S0"]["needs_review"] and x["S0"]["values_verified"] is None
    assert resolved["staged"]["S20"]["needs_review"] and resolved["release"]["S20"]["values_inherited"] is False
    r_ = torque.resolve(status.select("spec_sheet", "torque_mode", "audit_status"), mapping, profiles, facts, rows).drop("is_active")
    counts = {y["spec_sheet"]: y["count"] for y in torque.effective(r_, profiles, facts).groupBy("spec_sheet").count().collect()}
    assert all(counts[f"S{n}"] == 6 for n in (1, 2, 3, 4, 6, 7, 9)) and counts["S33"] == 2 and "S0" not in counts


def test_parity_checks(spark):
    docs, rows = torque_tables(spark)
    status = torque.classify(docs, rows, dims.profile_rules(spark))
    facts = torque.profile_values(rows, status).withColumn("profile_id", F.col("profile_code"))
    profiles = spark.createDataFrame([(c, k, lv, s, a, f"S{int(g)}", True) for c, k, lv, s, a, g in dims.PROFILES], "profile_id string, kind string, truth_level string, profile_status string, approval_status string, source_spec_sheet string, is_active boolean")
    mapping = status.where("profile_code is not null").select("spec_sheet", F.col("profile_code").alias("profile_id"), "mapping_type")
    resolved = torque.resolve(status.select("spec_sheet", "torque_mode", "audit_status"), mapping, profiles, facts, rows).drop("is_active").join(docs, "spec_sheet")
    effective = torque.effective(resolved, profiles, facts)
    legacy = rows.join(docs, "spec_sheet").select("slash_sheet")
    state = lambda *a: {x["name"] for x in quality.parity_checks(*a).collect() if x["status"] != "pass"}
    assert quality.parity_checks(legacy, resolved, effective).count() == 7 and state(legacy, resolved, effective) == set()
    few = effective.where("slash_sheet != '07' or fact_key not like '%mating%'")
    assert state(legacy, resolved, few) == {"inheriting sheets have the six verified facts of /05", "fact counts are those of the effective facts"}
    assert state(legacy, resolved.where("slash_sheet != '08'"), effective) >= {"/08 is isolated", "/08 needs review", "old values are all resolved"}
    more = effective.unionByName(effective.limit(1).withColumn("slash_sheet", F.lit("base")))
    assert "base has no effective facts" in state(legacy, resolved, more)


def test_documents_of_another_family_are_not_current(spark):
    docs = spark.createDataFrame([(1, "83513"), (2, "other"), (3, "83513")], "document_id int, spec_family string")
    configs = spark.createDataFrame([(1, "r1"), (2, "r1"), (3, "r2"), (1, "r1")], "document_id int, release_id string")
    pointer = spark.createDataFrame([("83513", "r1")], "spec_family string, release_id string")
    assert [x["document_id"] for x in release.current_documents(docs, configs, pointer).collect()] == [1]
    assert len(views.SHEETS) == 5


def test_release_gates(spark):
    docs, rows = torque_tables(spark)
    c = variants.configurations(_records(spark), _no_shapes(spark))
    manifest = docs.select("slash_sheet", F.sha2("spec_sheet", 256).alias("checksum"), F.when(F.col("slash_sheet") == "02", "MIL-DTL-83513/2H").otherwise(F.col("spec_sheet")).alias("spec_sheet"), F.when(F.col("slash_sheet") == "02", "MIL-DTL-83513/2H(4)").alias("doc_id"))
    records = manifest.select("slash_sheet", F.array().cast("array<string>").alias("flags"), F.col("checksum").alias("source_sha256"))
    counts = spark.createDataFrame(list({"03": 58, "04": 58, "08": 22, "09": 58}.items()), "slash_sheet string, n int")
    wires = c.join(counts, "slash_sheet").select("slash_sheet", F.explode(F.sequence(F.lit(1), "n")).alias("w"))
    profiles = spark.createDataFrame([(1, dims.MAIN, "canonical")], "profile_id int, profile_code string, kind string")
    facts = spark.createDataFrame([(1, th, sc) for _, th, sc, _, _ in dims.TORQUE_TABLE], "profile_id int, thread string, scope string")
    links = spark.createDataFrame([("05", 1, "uses_profile", False, True), ("02", 1, "references_profile", True, True), ("04", 1, "references_profile", True, True)], "slash_sheet string, profile_id int, mapping_type string, values_inherited boolean, values_verified boolean")
    runs = docs.select("slash_sheet", F.lit(0).alias("returncode"))
    gates = quality.release_gates(spark, manifest, runs, records, c, wires, profiles, facts, links)
    out = gates.collect()
    assert len(out) == 32 and [g["name"] for g in out if g["status"] != "pass"] == []
    broken = quality.release_gates(spark, manifest, runs, records.withColumn("source_sha256", F.lit("x")), c.where("slash_sheet != '09'"), wires, profiles, facts, links)
    assert {g["name"] for g in broken.collect() if g["status"] != "pass"} == {"no stale sources", "/09 has 7 configurations"}
    assert quality.all_green(gates).first()["may_promote"] and not quality.all_green(gates, "reuse").first()["may_promote"]
    assert quality.require_green(gates).count() == 32
    with pytest.raises(Exception, match="not every gate"):
        quality.require_green(broken).collect()


def test_publish(spark, tmp_path):
    root = str(tmp_path)
    records = _records(spark)
    docs = release.documents(records)
    c = release.configurations(variants.configurations(records, _no_shapes(spark)).drop("document_id"), docs, "r1")
    assert c.select("config_id").distinct().count() == c.count() == 244
    green = spark.createDataFrame([("a", "pass")], "name string, status string")
    red = spark.createDataFrame([("a", "fail")], "name string, status string")
    dry = release.write_release({"documents": docs, "configurations": c}, root, "r1")
    assert {x["table_name"]: x["n_rows"] for x in dry.collect()} == {"documents": 8, "configurations": 244} and not list(tmp_path.iterdir())
    release.write_release({"documents": docs, "configurations": c}, root, "r1", apply=True)
    empty, unknown = green.limit(0), spark.createDataFrame([("a", "pass"), ("b", None)], "name string, status string")
    late, early = datetime(2024, 2, 2), datetime(2024, 1, 1)
    for status, gates in (("staged", green), ("published", red), ("published", empty), ("published", unknown)):
        with pytest.raises(ValueError):
            release.publish(spark, root, "83513", "r1", status, gates, early, 1)
    release.publish(spark, root, "83513", "r1", "published", green, late, 1)
    pointer = release.publish(spark, root, "83513", "r2", "published", green, early, 2)  # the clock stepped back
    assert [x["release_id"] for x in pointer.collect()] == ["r2"]
    for n in (1, 2):
        with pytest.raises(ValueError, match="sequence"):
            release.publish(spark, root, "83513", "r1", "published", green, late, n)
    assert [x["release_id"] for x in release.active(spark, root).collect()] == ["r2"]
    old = spark.createDataFrame([("83513", "r1")], "spec_family string, release_id string")
    assert release.current(c, old).count() == 244 and release.current(c, pointer).count() == 0
    assert release.current_documents(docs, c, old).count() == 8
    edges = release.relationships(c.withColumn("mates_with", F.array(F.lit("MIL-DTL-83513/2"))).withColumn("hardware_ref", F.lit("MIL-DTL-83513/5")))
    assert edges.count() == 488 and {x["related_sheet"] for x in edges.select("related_sheet").distinct().collect()} == {"02", "05"}


def test_merge_and_partitions(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, ordinal int")
    assert sorted(map(tuple, release.merge(a, b, ["k"]).collect())) == [(1, "a"), (2, "d"), (3, "e")]
    path = str(tmp_path / "t")
    assert {x["k"]: x["n_rows"] for x in release.replace_partitions(a, path, ["k"]).collect()} == {1: 1, 2: 1} and not (tmp_path / "t").exists()
    release.replace_partitions(a, path, ["k"], apply=True)
    release.replace_partitions(spark.createDataFrame([(2, "z")], "k int, v string"), path, ["k"], apply=True)
    assert sorted((x["k"], x["v"]) for x in spark.read.parquet(path).collect()) == [(1, "a"), (2, "z")]


def test_table_chain(spark):
    q = tables.TableQuery(spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, v string"))
    ids = lambda df: sorted((x["k"], x["v"]) for x in df.collect())
    assert ids(q.eq("v", "a").select()) == [(1, "a")] and ids(q.eq("v", "a").eq("k", 3).select()) == [] and q.select("k").count() == 3
    assert sorted(x["k"] for x in q.eq("v", "a").delete().collect()) == [2, 3]
    more = spark.createDataFrame([(3, "z"), (4, "y")], "k int, v string")
    assert q.insert(more).count() == 5 and sorted(x["v"] or "" for x in q.upsert(more, "k").collect()) == ["", "a", "y", "z"]
    with pytest.raises(ValueError):
        q.delete()


def test_revisions(spark):
    def row(token, text, date):
        return f'<tr><td><a href="javascript:open(\'r.aspx?token={token}\')">x</a></td><td>{text}</td><td>A</td><td>{date}</td></tr>'

    html = "<table>" + row("1.1", "Revision H", "01-JAN-2019") + row("2.1", "Revision H, incorporating Amendment 4", "08-MAR-2023") + row("3.1", "Notice 1", "02-FEB-2024") + "</table>"
    e = web.revision_entries(spark.createDataFrame([("2", html)], "page string, html string"))
    assert e.count() == 2
    assert web.latest_revision(e).first()["token"] == "2.1"
    assert web.latest_revision(e, "J").count() == 0
    grid = spark.createDataFrame([(["", "MIL-DTL-83513/2H(4)", "A", "t", "08-MAR-2023", "77"], 1), (["", "MIL-DTL-83513/2G", "A", "t", "08-MAR-2013", "76"], 2), (["", "MIL-DTL-83513H", "A", "t", "01-JAN-2020", "75"], 3), (["", "MIL-DTL-83513/3H", "I", "t", "01-JAN-2020", "74"], 4), (["x"], 5)], "cells array<string>, ordinal int")
    assert {(x["document_key"], x["ident"]) for x in web.grid_rows(grid).collect()} == {("2", "77"), ("base", "75")}


def test_fetch_retries():
    import io
    import urllib.error

    seen = []

    def opener(request, timeout):
        seen.append(request.full_url)
        if len(seen) < 3:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", None, None)
        return io.BytesIO(b"ok")

    waits = []
    assert web.fetch("http://x/", opener=opener, wait=waits.append) == b"ok" and waits == [1.5, 3.0]

    def gone(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 404, "gone", None, None)

    assert web.fetch("http://x/", opener=gone) is None


def test_download_family(spark, tmp_path):
    """Details page to redirecting page to file; what fails is an error of its own row."""
    history = "<tr><td><a onclick=\"open('./ImageRedirector.aspx?token={0}.5',1);\">x</a></td><td>Revision H</td><td>A</td><td>08-MAR-2023</td></tr>"
    site = {
        "https://host/q/d.aspx?ident_number=1": history.format(11), "https://host/q/d.aspx?ident_number=2": history.format(12), "https://host/q/d.aspx?ident_number=3": "<table></table>",
        "https://host/q/d.aspx?ident_number=5": history.format(15), "https://host/q/ImageRedirector.aspx?token=15.5": "<a>nothing</a>",
        "https://host/q/ImageRedirector.aspx?token=11.5": '<a href="../../WMX/Default.aspx?token=7">x</a>', "https://host/q/ImageRedirector.aspx?token=12.5": '<a href="../../WMX/Default.aspx?token=8">x</a>',
        "https://host/WMX/Default.aspx?token=7": "%PDF-1.7 one", "https://host/WMX/Default.aspx?token=8": "<html>sorry</html>",
    }
    calls = tmp_path / "calls"
    calls.mkdir()

    def get(url):
        (calls / uuid.uuid4().hex).write_text(url)
        return site[url].encode() if url in site else None

    keys = [("base", 1), ("2", 2), ("3", 3), ("4", 4), ("5", 5)]
    docs = spark.createDataFrame([(k, f"https://host/q/d.aspx?ident_number={n}") for k, n in keys], "document_key string, details_url string")
    out = web.download_family(docs, str(tmp_path / "pdf"), str(tmp_path / "report"), pause=0, get=get)
    got = {x["document_key"]: x for x in out.collect()}
    assert {k: x["error"] for k, x in got.items()} == {"base": None, "2": "not a PDF", "3": "no revision", "4": "no revision", "5": "no link"}
    assert got["base"]["n_bytes"] == 12 and (tmp_path / "pdf" / "MIL-DTL-83513_base_rev_H.pdf").read_bytes() == b"%PDF-1.7 one"
    assert len(list((tmp_path / "pdf").glob("*.pdf"))) == 1
    seen = [f.read_text() for f in calls.iterdir()]
    assert len(seen) == len(set(seen)) == 10


def test_store(spark, tmp_path):
    """Uploads archive what they replace, moves and removals; dry runs, conflicts and plans done twice."""
    import hashlib

    root, landing = tmp_path / "store", tmp_path / "landing"
    (root / "03").mkdir(parents=True)
    landing.mkdir()
    for name, body in (("a.pdf", b"old a"), ("b.pdf", b"same b"), ("03/m.pdf", b"m")):
        (root / name).write_bytes(body)
    arriving = []
    for path, name, body in (("a.pdf", "1", b"new a"), ("b.pdf", "2", b"same b"), ("02/c.pdf", "3", b"c"), ("d.pdf", "4", b"d1"), ("d.pdf", "5", b"d2")):
        (landing / name).write_bytes(body)
        arriving.append((path, str(landing / name), hashlib.sha256(body).hexdigest()))
    rows = spark.createDataFrame([*arriving, ("e.pdf", None, None)], "path string, source string, checksum string")
    listed = lambda: {x["path"]: x["n_bytes"] for x in store.stored(spark, str(root)).collect()}
    # a plan reads the store only when it is looked at, so it is written before anything changes
    kept = lambda plan, name: (plan.write.parquet(str(tmp_path / name)), spark.read.parquet(str(tmp_path / name)))[1]
    before = listed()
    plan = kept(store.upload_plan(rows, store.stored(spark, str(root))), "plan")
    assert sorted((x["path"], x["action"]) for x in plan.collect()) == [("02/c.pdf", "add"), ("a.pdf", "replace"), ("b.pdf", "keep"), ("d.pdf", "conflict"), ("d.pdf", "conflict"), ("e.pdf", "missing")]
    assert {x["outcome"] for x in store.apply_plan(plan, str(root), str(tmp_path / "dry")).collect()} == {"planned"} and listed() == before
    for attempt in ("r1", "r2"):
        out = {x["path"]: x["outcome"] for x in store.apply_plan(plan, str(root), str(tmp_path / attempt), apply=True).collect()}
        assert out == {"02/c.pdf": "done", "a.pdf": "done", "b.pdf": "skipped", "d.pdf": "skipped", "e.pdf": "skipped"}
    old = hashlib.sha256(b"old a").hexdigest()[:12]
    assert (root / "a.pdf").read_bytes() == b"new a" and (root / f"archive/a.{old}.pdf").read_bytes() == b"old a"
    (root / "a.pdf").write_bytes(b"meanwhile")
    assert {x["path"]: x["outcome"] for x in store.apply_plan(plan, str(root), str(tmp_path / "r3"), apply=True).collect()}["a.pdf"] == "changed since"
    docs = spark.createDataFrame([("03/m.pdf", "04/m.pdf"), ("b.pdf", "02/c.pdf"), ("gone.pdf", "x.pdf"), ("a.pdf", "a.pdf")], "at string, want string")
    moves = kept(store.move_plan(docs, "at", "want", store.stored(spark, str(root))), "moves")
    assert sorted((x["source"], x["action"]) for x in moves.collect()) == [("03/m.pdf", "move"), ("b.pdf", "conflict"), ("gone.pdf", "missing")]
    for attempt in ("m1", "m2"):
        assert {x["source"]: x["outcome"] for x in store.apply_plan(moves, str(root), str(tmp_path / attempt), apply=True).collect()}["03/m.pdf"] == "done"
    assert "04/m.pdf" in listed() and "03/m.pdf" not in listed()
    gone = kept(store.remove_plan(spark.createDataFrame([("04/m.pdf",), ("zz",)], "path string"), store.stored(spark, str(root))), "gone")
    assert sorted(x["outcome"] for x in store.apply_plan(gone, str(root), str(tmp_path / "g1"), apply=True).collect()) == ["done", "skipped"]
    assert "04/m.pdf" not in listed() and not list(root.rglob("_*"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.apply_plan(gone, str(root), str(tmp_path / "g1"), apply=True)


def _fake_pdf():
    """A reader of PDF bytes for workers, so its classes are local."""

    class _Page:
        def __init__(self, text, rows):
            self.text, self.rows = text, rows

        def extract_text(self):
            return self.text

        def extract_words(self, **tolerance):
            assert tolerance == {"x_tolerance": 1.5, "y_tolerance": 3, "keep_blank_chars": False}
            return [{"text": w, "top": top, "x0": x} for top, x, w in self.rows]

    class _Document:
        def __init__(self, content):
            rows = [(100.0, 50.0, "B"), (101.9, 10.0, "A"), (110.0, 30.0, "Identifying"), (110.4, 10.0, "Part"), (110.2, 20.0, "or"), (110.0, 40.0, "Number:"), (120.0, 10.0, "A"), (120.0, 20.0, "="), (120.0, 30.0, "9"), (130.0, 10.0, "Referenced"), (130.0, 20.0, "documents"), (140.0, 1.0, "z")]
            known = "x\nPart or Identifying Number:\nA = 9\ny"
            self.pages = [_Page(content.decode(), rows), _Page(None, []), _Page("no block", rows[:2]), _Page(known, rows)]

        def __enter__(self):
            return self

        def __exit__(self, *error):
            return None

    return _Document


def test_page_text(spark):
    """Words of a line are read from left to right, and a part-number block that the text lacks goes to its end."""
    files = spark.createDataFrame([("f.pdf", bytearray(b"scrambled A 9"))], "path string, content binary")
    opened = _fake_pdf()
    got = [x["text"] for x in pdf.page_text(files, opened).orderBy("page_number").collect()]
    assert got == ["scrambled A 9\nWORD-LEVEL PIN BLOCK:\nPart or Identifying Number:\nA = 9", "", "no block", "x\nPart or Identifying Number:\nA = 9\ny"]
    words = pdf.words(files, opened).where("page_number = 1").withColumnRenamed("path", "doc_key")
    lines = [x["line"] for x in extract.word_lines(words).orderBy("line_no").collect()]
    assert lines == ["A B", "Part or Identifying Number:", "A = 9", "Referenced documents", "z"]
    parts = extract.pin_components(spark.createDataFrame([("2", 1, got[0])], "doc_key string, page_number int, text string")).first()
    assert [(x["insert_arrangement"], x["cavity_count"]) for x in parts["insert_arrangements"]] == [("A", 9)]


def test_files_and_metadata(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.pdf").write_bytes(b"no")
    got = {x["path"].rsplit("/", 1)[1]: x["is_pdf"] for x in tables.files(spark, str(tmp_path), "*.pdf").collect()}
    assert got == {"a.pdf": True, "b.pdf": False}
    (tmp_path / "m1.json").write_text('[{"slash_sheet": "2", "title": "old"}, {"document_key": "02", "title": "new"}]')
    (tmp_path / "m2.json").write_text('{"documents": [{"document_key": "base", "title": "b"}, {"title": "none"}]}')
    meta = {x["key"]: x["title"] for x in tables.document_metadata(spark, str(tmp_path / "*.json")).collect()}
    assert meta == {"02": "new", "base": "b"}
    if not pdf.available():
        with pytest.raises(RuntimeError):
            pdf.page_text(spark.createDataFrame([("a", b"x")], "path string, content binary"))


def test_torque_text(spark):
    p = pages(spark, "x", "Mounting and mating hardware: see MIL-DTL-83513/5, configuration A and B.", "Torque is 2.0 - 3.5 in-lbs. Nothing else.", "A length of 2 to 3 inch-pounds only.", "Mating hardware torque: shall be in accordance with MIL-DTL-83513/5. More.", key="1")
    rows = {x["page_number"]: x for x in extract.torque_facts(p).collect()}
    assert rows[2]["context"] == "hardware_reference" and rows[2]["applies_to"] == "MIL-DTL-83513/5"
    assert (rows[3]["min_in_lbf"], rows[3]["max_in_lbf"], rows[3]["torque_text"]) == (2.0, 3.5, "Torque is 2.0 - 3.5 in-lbs.")
    assert 4 not in rows and rows[5]["applies_to"] == "MIL-DTL-83513/5"
    table = spark.createDataFrame(dims.TORQUE_TABLE, "context string, thread string, scope string, low double, high double")
    seven = pages(spark, *["-"] * 6, "MIL-DTL-83513/5 mounting hardware; torque as required", key="5")
    assert extract.torque_facts(seven, table).count() == 6


def test_hardware(spark):
    d = spark.createDataFrame([("1", "MIL-DTL-83513/5 arrangements A through G"), ("2", "MIL-DTL-83513/5 configuration C"), ("3", "nothing")], "doc_key string, text string")
    got = extract.hardware_details(d, dims.hardware_options(spark)).groupBy("doc_key").count().collect()
    assert {x["doc_key"]: x["count"] for x in got} == {"1": 5, "2": 5}
    m = extract.mentioned_options(spark.createDataFrame([("5", "M83513/05-02"), ("6", "none")], "doc_key string, text string"), dims.hardware_options(spark), "M83513/05")
    assert {x["doc_key"]: x["count"] for x in m.groupBy("doc_key").count().collect()} == {"5": 1, "6": 10}


def test_lists_and_figures(spark):
    p = pages(spark, "MIL-DTL-83513/2 MIL-DTL-83513/5 MIL-DTL-83513/1 M83513/01-AN FIGURE 1", "FIGURE 1. Plug. 15", key="1")
    s = extract.page_summary(p)
    x = extract.document_lists(s).first()
    assert x["mates_with"] == ["MIL-DTL-83513/2"] and x["example_parts"] == ["M83513/01-AN"] and 15 in x["cavity_counts"]
    assert [f["title"] for f in extract.document_figures(s).collect()] == ["Plug"]
    chunks = extract.page_chunks(pages(spark, "a " * 1000, "  "), 1800)
    assert [(c["chunk_id"], c["chunk_index"]) for c in chunks.orderBy("chunk_index").collect()] == [("page-1-chunk-1", 1), ("page-1-chunk-2", 2)]
    assert extract.pages_from_chunks(chunks).count() == 1


def test_windows_and_sets(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, None), (1, 3, "b", "t")], "k int, o int, v string, title string")
    assert [x["c"] for x in r.carry_forward(df, "k", ["o"], "v", "c").orderBy("o").collect()] == ["a", "a", "b"]
    assert r.titled_first(df, ["k"], "title", "o").first()["o"] == 3
    assert r.first_wins(df, ["k"], "o").first()["o"] == 1 and r.last_wins(df, ["k"], "o").first()["o"] == 3
    steps = spark.createDataFrame([(1, 1, "none"), (1, 2, "needs_review"), (1, 3, "none"), (1, 4, "owns_profile"), (1, 5, "needs_review")], "k int, o int, s string")
    assert [(x["from_state"], x["to_state"]) for x in r.bad_transitions(steps, "k", ["o"], "s", dims.transitions(spark)).collect()] == [("owns_profile", "needs_review")]
    dup = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x")], "a int, b string")
    assert [tuple(x) for x in quality.unique_violations(dup, ["a", "b"]).collect()] == [(2, "x", 2)]


def test_streams(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        src.where(f"event_id % 3 = {i}").coalesce(1).write.mode("append").parquet(folder)
    stream = events.read_events(spark, folder, src.schema.simpleString()[7:-1].replace(":", " "))
    q = stream.writeStream.foreachBatch(events.upsert_not_older(out, "user_id", "ts", "event_id")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = events.current(spark, out, src.schema, "user_id", "ts", "event_id")
    assert sorted(map(tuple, last.select("user_id", "event_id").collect())) == sorted(map(tuple, r.latest(src, ["user_id"], "ts", "event_id").select("user_id", "event_id").collect()))
    q = events.tumbling(stream).writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tumbling").agg(F.sum("n")).first()[0] == src.count()
    every = events.read_events(spark, folder, src.schema.simpleString()[7:-1].replace(":", " "), 10)
    q = events.sessions(every).writeStream.format("memory").queryName("sessions").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("sessions").agg(F.sum("n")).first()[0] == src.count()


# --- properties


def column(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [x["y"] for x in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n c-", max_size=40), min_size=1, max_size=20))
def test_collapse(spark, values):
    assert column(spark, t.collapse, values) == [" ".join(x.split()) for x in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abc \n", max_size=60), min_size=1, max_size=10), st.integers(1, 9))
def test_chunks(spark, values, size):
    got = column(spark, lambda c: t.chunks(c, size), values)
    for x, y in zip(values, got, strict=True):
        plain = " ".join(x.split())
        assert [c["chunk_text"] for c in y] == [plain[i : i + size] for i in range(0, len(plain), size)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_uuid5(spark, values):
    assert column(spark, v.uuid5, values) == [str(uuid.uuid5(uuid.NAMESPACE_URL, x)) for x in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 99999), min_size=1, max_size=20))
def test_numbers(spark, values):
    assert column(spark, lambda c: v.short_number(c / 100), values, "int") == [f"{x / 100:.7g}" for x in values]
    assert column(spark, lambda c: t.zero_pad(c.cast("string")), values, "int") == [str(x).zfill(2) for x in values]


def test_text_functions(spark):
    one = lambda f, x: column(spark, f, [x])[0]
    assert [one(t.sheet_key, x) for x in ("2", "02", " base ", "", "x", None)] == ["02", "02", "base", None, None, None]
    assert one(t.document_filter, " /007 ") == "7"
    assert one(lambda c: t.mate_sheets(F.split(c, ",")), "MIL-DTL-83513/2,MIL-DTL-83513/2H,x,MIL/04") == ["02", "04"]
    assert one(t.termination_style, "PLUG_PIN_SOLDER") == "Solder"
    assert one(t.strip_tags, "<b>a&nbsp;&amp; b</b>") == "a & b"
    assert one(t.clean_part_number, "m83513/03–a 01 2/ n") == "M83513/03-A01N"
    assert one(lambda c: t.excerpt(c, F.lit(22), F.lit(25)), "First one. A 2.5 value is 3.0 here. Last.") == "A 2.5 value is 3.0 here."
    assert one(t.trim_bleed, "note text MIL-DTL-83513/3H 7") == "note text" and one(t.has_bleed, "supersedes page 3")
    assert one(lambda c: v.month_date("x"), "08-MAR-2023").isoformat() == "2023-03-08"
    assert one(lambda c: extract.block(F.split(c, "\n"), "^PIN", "^END"), "a\nPIN x\nb\nEND\nc") == ["PIN x", "b"]
    assert one(lambda c: extract.block(F.split(c, "\n"), "^PIN", "END"), "a\nPIN END\nb\nEND\nc") == ["PIN END", "b"]
    assert one(extract.solder_cup_limit, "The solder cup will accept size 26 AWG maximum wire") == 26
    assert one(extract.connector_notes, "Interfacial seal: silicone. x")["interfacial_seal"] == "silicone"
