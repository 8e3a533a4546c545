"""Scans behind a service, logs and loads, streams with state, pages, ranges, indexes and differences, against plain loops."""

import io
import json
import random
import threading
import urllib.error
from collections import Counter
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheetforge.operators import diffs, extract, inverted, paging, ranges
from sheetforge.operators import relational as r
from sheetforge.plans import payloads, release
from sheetforge.queries.served import Service
from sheetforge.sources import rest, store, tables, web
from sheetforge.sources.log import KeyedTable, Log, Taken
from sheetforge.streaming import events, modes

# --- a table behind a service

ROWS = [{"id": i, "name": f"n{i % 7}", "size": i % 10 if i % 4 else None, "at": datetime(2024, 1, 1) + timedelta(hours=i), "price": i / 4, "ok": i % 3 == 0} for i in range(95)]
SCHEMA = "id long, name string, size int, at timestamp, price double, ok boolean"


@pytest.fixture
def service():
    s = Service(tables={"things": pa.Table.from_pylist(ROWS), "none": pa.table({"id": pa.array([], pa.int64())})})
    yield s
    s.close()


def test_rest_scan_pushes_filters_and_columns(spark, service):
    df = rest.rest_table(spark, service.url, "catalog.things", SCHEMA, order="id", pageSize=10, token="t0")
    got = df.where((F.col("size") > 2) & F.col("name").isin("n1", "n2") & F.col("name").startswith("n") & F.col("price").isNotNull() & (F.col("id") % 2 == 0)).select("id", "name")
    want = [(x["id"], x["name"]) for x in ROWS if x["size"] is not None and x["size"] > 2 and x["name"] in ("n1", "n2") and x["id"] % 2 == 0]
    assert sorted(map(tuple, got.collect())) == want
    asked = [dict(q) for _, _, q, _ in service.requests]
    assert all(a["size"] in ("gt.2", "not.is.null") or "size" in a for a in asked) and all(a["name"].startswith(("in.", "like.", "not.")) for a in asked)
    assert all(h["Accept-Profile"] == "catalog" and h["Authorization"] == "Bearer t0" for *_, h in service.requests)
    assert "count=exact" in service.requests[0][3]["Prefer"]
    few = rest.rest_table(spark, service.url, "things", SCHEMA, ["id", "at"], order="id")
    assert sorted(tuple(x) for x in few.collect()) == [(x["id"], x["at"]) for x in ROWS]
    assert dict(service.requests[-1][2])["select"] == "id,at"


def test_rest_pages_are_tasks(spark, service):
    df = rest.rest_table(spark, service.url, "things", SCHEMA, order="id", pageSize=10)
    assert df.rdd.getNumPartitions() == 10 and df.count() == 95
    assert {dict(q)["offset"] for _, _, q, _ in service.requests} == {str(10 * i) for i in range(10)}
    service.counts = False  # without a total one task goes from page to page, to the first short one
    service.requests.clear()
    df = rest.rest_table(spark, service.url, "things", SCHEMA, order="id", pageSize=10)
    assert df.rdd.getNumPartitions() == 1 and sorted(x["id"] for x in df.collect()) == list(range(95))
    assert max(int(dict(q)["offset"]) for _, _, q, _ in service.requests) == 90
    service.counts = True
    assert rest.rest_table(spark, service.url, "none", "id long", order="id").count() == 0


@pytest.mark.parametrize("condition", ["name = 'n3'", "not name = 'n3'", "size is null", "size is not null and size <= 3", "name in ('n1', 'none')", "not name in ('n1')", "name like '%5'", "name like 'n%'", "name <=> 'n2'", "size > 3 or name = 'n1'", "ok", "price >= 20.25", "at < timestamp'2024-01-02 05:00:00'", "not size > 3", "id = 12 and name = 'n5'"])
def test_rest_conditions(spark, service, condition):
    """Whatever goes into the request, rows are those that Spark itself would keep."""
    df = rest.rest_table(spark, service.url, "things", SCHEMA, order="id", pageSize=50).where(condition)
    plain = spark.createDataFrame([tuple(x.values()) for x in ROWS], SCHEMA).where(condition)
    assert sorted(x["id"] for x in df.collect()) == sorted(x["id"] for x in plain.collect())


def test_rest_failures(spark, service):
    service.failures["GET"] = 2
    assert rest.rest_total(service.url, "things", [("name", "eq.n1")]) == sum(x["name"] == "n1" for x in ROWS)
    with pytest.raises(rest.RestError, match="400"):
        rest.rest_total(service.url, "things", [("name", "nonsense.1")])
    waits = []

    def broken(request, timeout):
        raise TimeoutError("slow")

    with pytest.raises(rest.RestError, match="slow"):
        rest.send("GET", "http://x", {}, wait=waits.append, opener=broken)
    assert waits == [0.5, 1.0]
    target = rest._Scan({"url": service.url, "table": "things", "order": "id"}, spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(rest.RestError, match="shrank"):
        list(target.read(rest._Page(90, 10)))
    assert rest.rest_page(service.url, "things", ["id"], order="id.desc".replace(".desc", ".asc"), limit=2, offset=200) == ([], 95)


def test_rest_upsert_and_delete(spark, service):
    df = spark.createDataFrame([(i, f"new{i}") for i in range(90, 110)], "id long, name string")
    service.tables["pairs"] = pa.table({"id": [1, 95], "name": ["a", "b"]})
    service.failures["POST"] = 1
    rest.rest_upsert(df.repartition(3), service.url, "catalog.pairs", batch=4)
    posts = [x for x in service.requests if x[0] == "POST"]
    assert len(posts) >= 6 and all(dict(q)["on_conflict"] == "id" and h["Content-Profile"] == "catalog" for _, _, q, h in posts)
    back = lambda: rest.rest_table(spark, service.url, "pairs", "id long, name string", order="id")
    assert sorted(map(tuple, back().collect())) == [(1, "a"), *[(i, f"new{i}") for i in range(90, 110)]]
    rest.rest_delete(service.url, "pairs", [("id", "gte.100")])
    assert back().count() == 11
    with pytest.raises(ValueError):
        rest.rest_delete(service.url, "pairs", [])


# --- logs, loads and publication


def test_log_entries_are_exclusive(spark, tmp_path):
    log = Log(spark, f"file://{tmp_path}/log")
    assert log.last() == (0, None)
    won = []

    def write(i):
        try:
            log.append(0, {"by": i})
            won.append(i)
        except Taken:
            pass

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert len(won) == 1 and log.last() == (1, {"by": won[0]})
    threads = [threading.Thread(target=log.change, args=(lambda last: {"n": last.get("n", 0) + 1},)) for _ in range(6)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert log.last()[1] == {"n": 6} and log.numbers() == list(range(1, 8))
    (tmp_path / "log" / f"{8:020d}.json").write_text('{"n":')  # a writer that died
    assert log.last() == (8, {"n": 6}) and log.append(8, {"n": 7}) == 9 and log.last() == (9, {"n": 7})


def tables_of(spark, version, keys=("a", "b"), status="published"):
    out = {n: spark.createDataFrame([(k, version) for k in keys], "id string, version int") for n in release.LOAD_ORDER}
    out["publish.releases"] = spark.createDataFrame([(f"r{version}", status)], "id string, status string")
    out[release.POINTER] = spark.createDataFrame([("83513", f"r{version}")], "spec_family string, release_id string")
    return out


GREEN, RED = [("a", "pass")], [("a", "fail")]
AT = datetime(2024, 1, 1)


def gates(spark, rows):
    return spark.createDataFrame(rows, "name string, status string")


def test_one_pointer_whoever_moves_it(spark, tmp_path):
    """A load and a publication in both orders: the largest sequence number is active, and both ways say so."""
    root, green = f"file://{tmp_path}/one", gates(spark, GREEN)
    active = lambda: [tuple(x) for x in release.active(spark, root).collect()]
    release.load_release(tables_of(spark, 1), root, 1, green, AT, apply=True)
    assert active() == [("83513", "r1")] == [tuple(x) for x in release.loaded(spark, root, release.POINTER).collect()]
    release.publish(spark, root, "83513", "other", "published", green, AT, 2)
    assert active() == [("83513", "other")]
    release.load_release(tables_of(spark, 3), root, 3, green, AT, apply=True)
    assert active() == [("83513", "r3")]
    with pytest.raises(ValueError, match="sequence"):
        release.publish(spark, root, "83513", "late", "published", green, AT, 3)
    with pytest.raises(ValueError, match="active"):
        release.publish(spark, root, "83513", "r9", "published", green, AT, 9, expected="r1")
    release.publish(spark, root, "83513", "r9", "published", green, AT, 9, expected="r3")
    release.publish(spark, root, "other", "x", "published", green, AT, 1)
    assert sorted(active()) == [("83513", "r9"), ("other", "x")]


def test_publishers_at_once(spark, tmp_path):
    root, green = f"file://{tmp_path}/race", gates(spark, GREEN)
    said = []

    def publish(i):
        try:
            release.publish(spark, root, "83513", f"r{i}", "published", green, AT, 7)
            said.append(i)
        except ValueError:
            pass

    threads = [threading.Thread(target=publish, args=(i,)) for i in range(5)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert len(said) == 1 and [x["release_id"] for x in release.active(spark, root).collect()] == [f"r{said[0]}"]


def test_loads(spark, tmp_path, monkeypatch):
    root, green = f"file://{tmp_path}/load", gates(spark, GREEN)
    dry = release.load_release(tables_of(spark, 1), root, 1)
    assert [(x["position"], x["n_rows"]) for x in dry.orderBy("position").collect()] == [(i, 1 if i in (0, 14) else 2) for i in range(15)] and not (tmp_path / "load").exists()
    for bad in (None, gates(spark, RED), green.limit(0), lambda t: gates(spark, RED)):  # nothing moves without gates that pass
        with pytest.raises(ValueError, match="gate"):
            release.load_release(tables_of(spark, 1), root, 1, bad, AT, apply=True)
    assert release.active(spark, root).count() == 0
    with pytest.raises(ValueError, match="nothing"):
        release.loaded(spark, root, "ingest.documents")
    release.load_release(tables_of(spark, 1), root, 1, green, AT, apply=True)
    for _ in range(2):  # and done again
        release.load_release(tables_of(spark, 2, ("b", "c")), root, 2, green, AT, apply=True)
    rows = lambda: sorted(map(tuple, release.loaded(spark, root, "ingest.documents").collect()))
    assert rows() == [("a", 1), ("b", 2), ("c", 2)] and release.loaded(spark, root, "publish.releases").count() == 2
    none = tables_of(spark, 3)
    none.pop("ingest.documents")
    strange = tables_of(spark, 3) | {release.POINTER: spark.createDataFrame([("83513", "nowhere")], "spec_family string, release_id string")}
    for wrong, sequence, why in ((none, 3, "ingest.documents"), (tables_of(spark, 3, ("a", "a")), 3, "twice"), (tables_of(spark, 3, ("a", None)), 3, "null"), (tables_of(spark, 1), 1, "below"), (strange, 3, "nowhere")):
        with pytest.raises(ValueError, match=why):
            release.load_release(wrong, root, sequence, green, AT, apply=True)
    assert rows() == [("a", 1), ("b", 2), ("c", 2)]  # what those have left isn't read
    release.load_release(tables_of(spark, 4, ("d",), "staged"), root, 4, green, AT, apply=True)
    assert [x["release_id"] for x in release.active(spark, root).collect()] == ["r2"] and ("d", 4) in rows()
    before = rows()
    release.compact(spark, root)
    assert rows() == before and len(release._loads(spark, root).last()[1]["loads"]) == 1


def test_a_load_that_fails_leaves_nothing(spark, tmp_path):
    root, green = f"file://{tmp_path}/cut", gates(spark, GREEN)
    release.load_release(tables_of(spark, 1), root, 1, green, AT, apply=True)
    broken = tables_of(spark, 2)
    broken["catalog.fact_evidence"] = spark.createDataFrame([("a", 2), ("b", 2)], "id string, version int").withColumn("version", F.when(F.col("id") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("version")))
    with pytest.raises(Exception, match="lost"):
        release.load_release(broken, root, 2, green, AT, apply=True)
    assert sorted(map(tuple, release.loaded(spark, root, "ingest.documents").collect())) == [("a", 1), ("b", 1)]
    assert [x["release_id"] for x in release.active(spark, root).collect()] == ["r1"]


def test_orphans(spark):
    have = {n: spark.createDataFrame([("x",)], "id string") for n in release.LOAD_ORDER}
    for child, column, _ in payloads.REFERENCES:
        have[child] = have[child].withColumn(column, F.lit("x"))
    assert payloads.orphans(have).count() == 0 and payloads.orphan_gate(have).first()["status"] == "pass"
    have["ingest.documents"] = have["ingest.documents"].where("false")
    have["catalog.wire_options"] = have["catalog.wire_options"].withColumn("configuration_id", F.lit("y"))
    have["catalog.torque_profiles"] = have["catalog.torque_profiles"].withColumn("source_document_id", F.lit(None).cast("string"))  # refers to nothing
    lost = {(x["table_name"], x["column_name"], x["missing_id"]) for x in payloads.orphans(have).collect()}
    assert lost == {(c, k, "x") for c, k, p in payloads.REFERENCES if p == "ingest.documents" and c != "catalog.torque_profiles"} | {("catalog.wire_options", "configuration_id", "y")}
    assert payloads.orphan_gate(have).first()["status"] == "fail"


def test_keyed_table(spark, tmp_path):
    """Many additions in no order equal one pass over all; what an addition writes follows the addition."""
    rng = random.Random(1)
    rows = [(rng.randrange(60), rng.randrange(40), i, f"v{i}") for i in range(400)]
    schema = "k int, at int, tie int, v string"
    every = spark.createDataFrame(rows, schema)
    kept = KeyedTable(spark, f"file://{tmp_path}/t", every.schema, "k", "at", "tie", buckets=8, most=3)
    assert kept.read().count() == 0
    for i in range(0, 400, 40):
        kept.add(spark.createDataFrame(rows[i : i + 40], schema), i)
    kept.add(spark.createDataFrame(rows[:40], schema), 0)  # an older batch again
    entry = kept.add(spark.createDataFrame([(1, 99, 0, "last")], schema), 500)
    want = {}
    for k, at, tie, v in [*rows, (1, 99, 0, "last")]:
        if k not in want or (-at, tie) < (-want[k][0], want[k][1]):
            want[k] = (at, tie, v)
    assert {x["k"]: (x["at"], x["tie"], x["v"]) for x in kept.read().collect()} == want
    assert max(map(len, entry["buckets"].values())) <= 4
    last = entry["folders"][-1]
    assert len(kept._written(last)) == 1  # one row touches one bucket
    before = kept.read().count()
    assert kept.vacuum() and kept.read().count() == before


def test_two_writers_of_a_keyed_table(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, at int, tie int").schema
    threads = [threading.Thread(target=lambda i=i: KeyedTable(spark, f"file://{tmp_path}/w", schema, "k", "at", "tie", 4).add(spark.createDataFrame([(k, i, 0) for k in range(10)], schema))) for i in range(4)]
    [x.start() for x in threads], [x.join() for x in threads]
    got = KeyedTable(spark, f"file://{tmp_path}/w", schema, "k", "at", "tie", 4).read().collect()
    assert sorted((x["k"], x["at"]) for x in got) == [(k, 3) for k in range(10)]


# --- streams with state

ALLOWED = [("a", "b"), ("b", "c"), ("c", "a")]


def stream_rows(seed, n=120):
    rng = random.Random(seed)
    return [(i, datetime(2024, 1, 1) + timedelta(minutes=10 * i + rng.randrange(10)), f"k{rng.randrange(4)}", rng.choice("abc")) for i in range(n)]


@pytest.mark.parametrize("cuts, idle_ms", [([30, 60, 90], None), ([7, 8, 100], None), ([40, 80], 3_600_000)])
def test_states_do_not_depend_on_batches(spark, tmp_path, cuts, idle_ms):
    """The stream equals the batch form, also when it stops after some files and goes on from its checkpoint."""
    schema = "event_id long, ts timestamp, who string, state string"
    rows = stream_rows(2)
    allowed = F.lit(False)
    for a, b in ALLOWED:
        allowed = allowed | ((F.col("from_state") == a) & (F.col("to_state") == b))
    want = modes.rejected_in_batch(spark.createDataFrame(rows, schema), "who", "ts", "event_id", "state", allowed, idle_ms)
    folder = str(tmp_path)

    def more(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        out = modes.rejected_steps(source, "who", "ts", "event_id", "state", ALLOWED, idle_ms=idle_ms)
        events.run_once(out, f"{folder}/out", f"{folder}/checkpoint")
        return spark.read.schema(out.schema).parquet(f"{folder}/out")

    for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        got = more(rows[lo:hi])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_strict_states_and_late_rows():
    """The processor itself: a rejected step doesn't move a strict state, and a row before the last one is late."""
    from pyspark.sql import Row

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, x):
            self.held = x

        def clear(self):
            self.held = None

    for strict, want in ((True, [(2, "a", "c"), (3, "a", "a")]), (False, [(2, "a", "c")])):
        s = modes.Steps(set(ALLOWED), None, strict)
        s.last = Value()
        run = lambda *rows: [(x["event_id"], x["from_state"], x["to_state"], x["outcome"]) for x in s.handleInputRows(("k",), iter([Row(at_us=t, event_id=i, state=c) for t, i, c in rows]), None)]  # noqa: B023, E731
        assert [x[:3] for x in run((30, 3, "a"), (10, 1, "a"), (20, 2, "c"))] == want
        assert run((5, 9, "b")) == [(9, "a", "b", "late")] and run((40, 4, "b")) == []


# --- pages


@pytest.mark.parametrize("order", [["a", "b", "c"], ["-a", "b", "-c"], ["b", "-c", "a"]])
def test_rank_pages(spark, order):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(5)]), rng.choice([None, "x", "y", "é"]), i % 300) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    key = {"a": 0, "b": 1, "c": 2}

    def place(row):
        out = []
        for k in order:
            v = row[key[k.removeprefix("-")]]
            n = -1 if v is None else v if isinstance(v, int) else "xyé".index(v)
            out.append(-n if k.startswith("-") else n)
        return out

    ordered = sorted(rows, key=place)
    for offset in (0, 1, 433, 899, 900, 5000):
        page = paging.rank_page(df, order, 30, offset, piece=40, fan=4)
        assert page.total == 900 and [tuple(x) for x in page.rows.collect()] == ordered[offset : offset + 30]
    distinct = sorted(set(rows), key=place)
    once = spark.createDataFrame(distinct, "a int, b string, c int")
    seen = dict(zip("abc", distinct[100], strict=True))
    assert [tuple(x) for x in paging.after(once, order, tuple(seen[k.removeprefix("-")] for k in order), 20).collect()] == distinct[101:121]
    assert [tuple(x) for x in paging.after(once, order, None, 3).collect()] == distinct[:3]
    with pytest.raises(ValueError):
        paging.rank_page(df, order, 0)


def test_a_table_that_cannot_be_split(spark):
    page = paging.rank_page(spark.createDataFrame([(1,)] * 500, "a int"), ["a"], 5, 490, piece=10)
    assert page.total == 500 and page.rows.count() == 5


def test_page_totals(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "a int")
    assert [tuple(x) for x in r.page(df, [F.col("a")], 3, 5).collect()] == [(5, 7), (6, 7)]
    assert [tuple(x) for x in r.page(df, [F.col("a")], 3, 7).collect()] == [(None, 7)] == [tuple(x) for x in r.page(df, [F.col("a")], 3, 90).collect()]
    assert r.page(df.limit(0), [F.col("a")], 3).count() == 0 and r.page(df, [F.col("a")], 3, 9, None).count() == 0


def test_gap_runs(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 9), (1, 10), (2, 5), (3, None), (4, 1), (4, 2)], "k int, v int")
    assert [tuple(x) for x in r.gap_runs(df, "k", "v").collect()] == [(1, 4, 8)]
    assert sorted(x["v"] for x in r.gaps(df, "k", "v").collect()) == [4, 5, 6, 7, 8]


# --- ranges


def test_in_ranges(spark):
    rng = random.Random(4)
    points = [(i, rng.choice([None, 0, -1, -7, 5, 1000, rng.randrange(-3000, 3000), rng.randrange(300)])) for i in range(300)]
    spans = [(f"r{i}", lo, lo + rng.choice([0, 1, 3, 100, 5000])) for i in range(60) for lo in [rng.randrange(-3000, 3000)]] + [("none", 5, 4), ("open", None, 9), ("whole", -(2**40), 2**40), ("same", 5, 5), ("same", 5, 5)]
    p, s = spark.createDataFrame(points, "i int, x long"), spark.createDataFrame(spans, "name string, lo long, hi long")
    want = Counter((i, name) for i, x in points for name, lo, hi in spans if None not in (x, lo, hi) and lo <= x <= hi)
    met = ranges.in_ranges(p, s, "x")
    assert Counter((y["i"], y["name"]) for y in met.collect()) == want
    alone = Counter((i, None) for i, x in points if x is None)
    assert Counter((y["i"], y["name"]) for y in ranges.in_ranges(p, s, "x", how="left").collect()) == want + alone
    assert ranges.in_ranges(p, s.limit(0), "x").count() == 0 and ranges.in_ranges(p, s.limit(0), "x", how="left").count() == len(points)
    plan = met._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    half = spark.createDataFrame([(1, 0.74), (2, 0.75), (3, -2.5)], "i int, x double")
    wide = spark.createDataFrame([("a", 0.75, 3.0), ("b", -2.5, 0.74)], "name string, lo double, hi double")
    assert sorted((y["i"], y["name"]) for y in ranges.in_ranges(half, wide, "x", unit=0.5).collect()) == [(1, "b"), (2, "a"), (3, "b")]


def test_dyadic_blocks(spark):
    rng = random.Random(5)
    spans = [(lo, lo + rng.randrange(0, 200)) for lo in (rng.randrange(-500, 500) for _ in range(40))] + [(0, 0), (-1, 0), (7, 6)]
    got = spark.createDataFrame(spans, "lo long, hi long").select("lo", "hi", ranges.dyadic(F.col("lo"), F.col("hi")).alias("b")).collect()
    for x in got:
        covered = sorted(v for n in x["b"] for v in range(n["node"] << n["level"], (n["node"] + 1) << n["level"]))
        assert covered == list(range(x["lo"], x["hi"] + 1)) and len(x["b"]) <= 2 * 9


# --- indexes


def test_json_containment(spark, tmp_path):
    rng = random.Random(6)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind == 0:
            return rng.choice([1, 1.0, 2, 2.5, True, False, None])
        if kind in (1, 2):
            return rng.choice(["a", "b", "é", "a.b", ""])
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice("xyz"): value(depth - 1) for _ in range(rng.randrange(4))}

    docs = [(i, json.dumps(value(3))) for i in range(150)] + [(900, None), (901, "{broken"), (902, "[1, [2]]"), (903, '"a"'), (904, "NaN")]
    df = spark.createDataFrame(docs, "id long, body string")
    index = inverted.json_index(df, "id", "body", f"{tmp_path}/json", buckets=4)
    parsed = {i: inverted._parsed(x) for i, x in docs}
    for part in ["{}", "[]", "1", '"a"', '{"x":{}}', '{"x":"a"}', '{"x":[],"y":{}}', "[[]]", '[{"x":{}}]', '{"z":1}', "true", "null", '{"x":{"y":"b"}}', "[1,[2]]"]:
        wanted = json.loads(part)
        want = {i for i, v in parsed.items() for x in v if inverted.json_contains(x, wanted) or (isinstance(x, list) and not isinstance(wanted, (dict, list)) and inverted.json_contains(x, [wanted]))}
        assert {x["id"] for x in inverted.search_json(df, "id", "body", index, part).collect()} == want
    assert inverted.json_contains([1, 2, {"a": [3]}], [{"a": []}, 2.0]) and not inverted.json_contains([True], [1]) and not inverted.json_contains({"a": 1}, {"a": {}})


def test_substring_index(spark, tmp_path):
    rng = random.Random(7)
    texts = [(i, *["".join(rng.choice("abÀé%_ xY") for _ in range(rng.randrange(9))) or None for _ in range(2)]) for i in range(300)]
    df = spark.createDataFrame(texts, "id int, p string, q string")
    index = inverted.substring_index(df, "id", ["p", "q"], f"{tmp_path}/grams", buckets=8)
    for needle in ["a", "", "%", "ab", "abÀ", "ABà", "é%_", "_ x", "XY", "xyx", "zzz", "b%a"]:
        want = {i for i, *cols in texts if any(c is not None and needle.lower() in c.lower() for c in cols)}
        assert {x["id"] for x in inverted.search_substring(df, "id", ["p", "q"], index, needle).collect()} == want
    read = index.ids("abà")._jdf.queryExecution().toString()
    assert "PartitionFilters" in read and "bucket" in read
    with pytest.raises(ValueError):
        index.all_of([])


# --- differences


@pytest.mark.parametrize("listed", [500, 0])
def test_tree_diff(spark, tmp_path, listed, monkeypatch):
    monkeypatch.setattr(diffs, "RANGES", listed)
    rows = [(k, f"v{k % 9}", None if k % 5 else k / 3) for k in [*range(-300, 3000), 10**15]]
    changed = {-300: "lost", 17: "changed", 18: "changed", 2500: "lost", 77_777: "added", 10**15: "changed"}
    other = [(k, v + "x", w) if changed.get(k) == "changed" else (k, v, w) for k, v, w in rows if changed.get(k) != "lost"] + [(77_777, "n", None), (5, "v5", 5.0)]
    a, b = (spark.createDataFrame(x, "k long, v string, w double") for x in (rows, other))
    shape = diffs.Shape("k", leaf=16, fan=8)
    want = changed | {5: "changed"}  # a second row of a key
    assert {x["key"]: x["kind"] for x in diffs.tree_diff(a, b.select("w", "v", "k"), shape).collect()} == want
    for name, df in (("a", a), ("b", b)):
        df.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/{name}")
        diffs.checksums(df, shape).write.parquet(f"{tmp_path}/{name}_sums")
    a, b, sa, sb = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("a", "b", "a_sums", "b_sums"))
    out = diffs.tree_diff(a, b, shape, sa, sb)
    assert {x["key"]: x["kind"] for x in out.collect()} == want
    if listed:
        leaves = {x["node"] for x in diffs.differing_leaves(sa, sb, shape).collect()}
        assert leaves == {k // 16 for k in want}
        assert "PushedFilters: [Or" in out._jdf.queryExecution().toString()
    assert diffs.tree_diff(a, a, shape, sa, sa).count() == 0
    with pytest.raises(ValueError):
        diffs.tree_diff(a, b.drop("w"), shape)


# --- long lines


def test_tables_with_very_long_lines(spark):
    """Decimals behind ten thousand other tokens count."""
    far = " ".join(["x"] * 10_001)
    pages = spark.createDataFrame([("1", 1, f"9 {far} .785 .408 .300 .299")], "doc_key string, page_number int, text string")
    assert [(x["cavity_count"], x["dimensions"]["A"]) for x in extract.geometry_rows(pages).collect()] == [(9, 0.785)]
    pages = spark.createDataFrame([("10", 1, f"NUMBER OF\nCONTACTS A B D\n9 {far} .785 .400 .308")], "doc_key string, page_number int, text string")
    assert [(x["cavity_count"], x["dimensions"]["D"]) for x in extract.pcb_rows(pages).collect()] == [(9, 0.308)]


# --- moves that wait for each other


def bytes_of(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file() and not any(x.startswith((".", "_")) for x in p.relative_to(root).parts)}


@pytest.mark.parametrize("cut", [None, 0, 1, 2, 3, 5, 8, 11])
def test_dependent_moves(spark, tmp_path, monkeypatch, cut):
    """A swap, a chain, a cycle of three and what waits for a file that stays; also after a cut behind any number of steps."""
    root = tmp_path / "store"
    have = {"a": "A", "b": "B", "c1": "1", "c2": "2", "c3": "3", "x": "X", "y": "Y", "z": "Z", "w1": "W", "w2": "V", "stay": "S", "f": "F", "same": "E", "equal": "E"}
    want = {"a": "b", "b": "a", "c1": "c2", "c2": "c3", "c3": "free/c4", "x": "y", "y": "z", "z": "x", "w1": "w2", "w2": "stay", "f": "f", "gone": "g", "same": "equal"}
    for name, text in have.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    docs = spark.createDataFrame(list(want.items()), "have string, want string")
    plan = store.dependent_move_plan(docs, "have", "want", store.stored(spark, str(root)), str(tmp_path / "work"))
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    assert {x["source"]: x["action"] for x in plan.collect()} == {"a": "park", "b": "park", "c1": "move", "c2": "park", "c3": "park", "x": "park", "y": "park", "z": "park", "w1": "conflict", "w2": "conflict", "gone": "missing", "same": "move"}
    dry = store.apply_moves(plan, str(root), str(tmp_path / "none"))
    assert {x["outcome"] for x in dry.collect()} == {"planned"} and bytes_of(root) == have
    if cut is not None:  # some steps of the two rounds, one by one
        rows = [tuple(x) for x in plan.collect()]
        steps = [("park", *x[1:]) for x in rows if x[0] == "park"] + [("unpark" if x[0] == "park" else x[0], *x[1:]) for x in rows]
        for action, path, source, archive, checksum, old in steps[:cut]:
            store._carried_out(str(root), action, path, source, archive, checksum, old)
    for n in range(2):  # and done again
        out = store.apply_moves(plan, str(root), str(tmp_path / f"report{n}"), apply=True)
        assert {x["outcome"] for x in out.where("action in ('move', 'unpark')").collect()} == {"done"}
    after = {"b": "A", "a": "B", "c2": "1", "c3": "2", "free/c4": "3", "y": "X", "z": "Y", "x": "Z", "w1": "W", "w2": "V", "stay": "S", "f": "F", "equal": "E"}
    assert bytes_of(root) == after and not [p for p in (root / store.PARKED).rglob("*") if p.is_file()]


# --- searches


def test_grid_search(spark):
    """A search box, pages with a session, a next link, and the latest document of each key; the first of equals."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs, urlsplit

    def row(doc, status, date, title, ident, kind="item"):
        return f'<tr class="grid_{kind}"><td>x</td><td> {doc} </td><td>{status}</td><td></td><td>{date}</td><td><b>{title}</b> &amp; more</td><td><a href="d.aspx?ident_number={ident}&amp;x=1">d</a></td></tr>'

    pages = [
        row("MIL-DTL-83513/2H", "A", "01-JAN-2020", "old", 1) + row("MIL-DTL-83513G", "a", "02-FEB-2020", "base", 2, "alternate") + row("MIL-DTL-83513/3G", "I", "02-FEB-2020", "inactive", 3),
        row("MIL-DTL-83513/2J", "A", "01-JAN-2021", "new", 4) + row("MIL-DTL-83513/2J", "A", "01-JAN-2021", "twin", 5) + "<tr class='grid_item'><td>broken",
        row("MIL-PRF-1/2J", "A", "01-JAN-2021", "other", 6) + row("MIL-DTL-83513/10A(1)", "A", "05-MAY-2019", "ten", "none"),
    ]
    seen, busy = [], Counter({"/s": 1})

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            asked = parse_qs(urlsplit(self.path).query)
            n, term = int(asked.get("page", ["0"])[0]), asked.get("box", [""])[0]
            seen.append((term, n, self.headers.get("Cookie")))
            if busy["/s"]:
                busy["/s"] -= 1
                return self.send_error(503)
            onward = f'<a class="n" rel="next" href="?box={term}&amp;page={n + 1 if n < 2 else 0}">next</a>'
            body = f"<table>{pages[n] if term == '83513' else ''}</table>{onward if term == '83513' else ''}".encode()
            self.send_response(200)
            self.send_header("Set-Cookie", f"session={term}")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        web.register(spark)
        url = f"http://127.0.0.1:{server.server_address[1]}/s"
        search = lambda terms: spark.read.format("grid_search").options(url=url, terms=terms, field="box", pause=0, parallel=2).load()
        rows = search("83513\nnothing").cache()
        assert sorted((x["page"], x["ordinal"]) for x in rows.collect()) == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 4), (2, 5), (2, 6)]
        found = {x["document_key"]: (x["doc_id"], x["title"], x["ident"]) for x in web.found_documents(rows).collect()}
        assert found == {"base": ("MIL-DTL-83513G", "base & more", "2")} | {"2": ("MIL-DTL-83513/2J", "new & more", "4")}
        asked = [x for x in seen if x[0] == "83513"]
        assert [n for _, n, _ in asked] in ([0, 0, 1, 2, 0], [0, 1, 2, 0], [0, 0, 1, 2], [0, 1, 2]) and asked[-1][2] == "session=83513"
        assert search("83513\nb\nc\nd").rdd.getNumPartitions() == 2
        got = spark.read.format("web_pages").options(urls=f"{url}?box=1 {url}?box=2", pause=0, urlsPerPartition=1).load()
        assert got.rdd.getNumPartitions() == 2 and all(x["html"] == "<table></table>" for x in got.collect())
    finally:
        server.shutdown()


def test_fetch_tries_broken_connections_again():
    calls = []

    def opener(request, timeout):
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError if len(calls) == 1 else ConnectionResetError
        return io.BytesIO(b"ok")

    assert web.fetch("http://x/", opener=opener, wait=lambda s: None) == b"ok"
    with pytest.raises(urllib.error.URLError):
        web.fetch("http://x/", opener=lambda *a, **k: (_ for _ in ()).throw(urllib.error.URLError("no host")), wait=lambda s: None)


# --- a catalog over tables


def test_table_catalog(spark, tmp_path):
    """The same answers with and without lists."""
    from sheetforge.operators import search

    rows = [(str(i), "02" if i % 2 else "03", "T", 9, "A", "K", "Plug" if i % 2 else "Receptacle", "Pin" if i % 3 else "Socket", f"part {i}%", "DESC", f"M83513/02-A{i}", "S", "H", 1, ["MIL-DTL-83513/2", "MIL-DTL-83513/3"], None, "{}") for i in range(30)]
    names = "config_id slash_sheet connector_type cavity_count:int shell_letter finish_code gender contact_type name description example_pin spec_sheet revision source_page:int mates_with:array<string> hardware_ref attributes"
    configs = spark.createDataFrame(rows, ", ".join(n.replace(":", " ") if ":" in n else f"{n} string" for n in names.split()))
    wires = spark.createDataFrame([("4", "01", "w")], "config_id string, wire_code string, wire_spec string")
    effective, raw = spark.createDataFrame([("S", "3 in-lbf")], "spec_sheet string, torque_text string"), spark.createDataFrame([("02", "raw")], "slash_sheet string, torque_text string")
    plain = search.TableCatalog(configs, wires, effective, raw)
    listed = search.TableCatalog(configs, wires, effective, raw, inverted.substring_index(configs, "config_id", list(search.SEARCHED), f"{tmp_path}/i", 4))
    assert isinstance(plain, search.Catalog)
    for filters in ({"query": "PART 1"}, {"query": "1%", "limit": 5}, {"query": "5% "}, {"query": "zzzz"}, {"gender": "plug", "query": "a2"}, {"slash_sheet": 2, "limit": 3, "offset": 20}, {}):
        one, two = ([tuple(x) for x in c.search_raw(**filters).select("config_id", "total").collect()] for c in (plain, listed))
        assert one == two
    assert [x["total"] for x in listed.search_raw(query="part 1", offset=50).collect()] == [11]
    assert plain.search_grouped(query="part").collect() == listed.search_grouped(query="part").collect() != []
    assert plain.part_detail("4").first()["torque"] == ["3 in-lbf"] and plain.part_detail("none").count() == 0
    assert plain.mates_raw("4").count() == 30 - 0 and plain.mates_grouped("4").count() == 2


def test_many_rules(spark):
    """Hundreds of rules, also overlapping: a row for each that holds the number."""
    from sheetforge.operators import torque

    rules = spark.createDataFrame([(i, i + 2, f"p{i}") for i in range(0, 300, 2)], "lo int, hi int, profile_code string")
    docs = spark.createDataFrame([("a", 4), ("b", 5), ("c", None), ("d", 999)], "name string, n int")
    got = sorted((x["name"], x["profile_code"] or "") for x in torque.by_rule(docs, rules, "n").collect())
    assert got == [("a", "p2"), ("a", "p4"), ("b", "p4"), ("c", ""), ("d", "")]


def test_verdict_cases(spark):
    from sheetforge.operators import quality

    df = spark.createDataFrame([("pass", "a"), ("pass", "b"), ("fail", "c")], "verdict string, case_id string")
    assert sorted(map(tuple, quality.verdict_cases(df).collect())) == [("fail", 1, "c"), ("pass", 2, "a"), ("pass", 2, "b")]


def test_chains_refuse_what_they_would_ignore(spark):
    q = tables.TableQuery(spark.createDataFrame([(1, "a")], "k int, v string")).eq("v", "a")
    for wrong in (lambda: q.insert(q.rows), lambda: q.upsert(q.rows, "k")):
        with pytest.raises(ValueError, match="equalities"):
            wrong()
