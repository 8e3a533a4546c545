"""Queries on tables that differ from the smallest ones in what their size brings: long keys, broken groups, hot keys, many pages."""

import os

import duckdb
import pytest

from sheetforge.queries import ORACLE_SQL, QUERIES

from test_oracles import FOLDER, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


def tables(folder, **changed):
    """Links to the smallest tables, with some of them made by SQL over them."""
    for name in os.listdir(FOLDER):
        if name.removesuffix(".parquet") not in changed:
            os.symlink(f"{FOLDER}/{name}", f"{folder}/{name}")
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW given_{name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{name}')")
    for name, sql in changed.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{folder}/{name}')")
    return str(folder), con


def same(spark, name, folder, con):
    want = rows(con.execute(ORACLE_SQL[name]).df())
    assert rows(QUERIES[name](spark, folder).toPandas()) == want
    return want[1]


def test_part_numbers_of_three_digits(spark, tmp_path):
    folder, con = tables(tmp_path, supplier="SELECT * REPLACE (s_suppkey + 95 AS s_suppkey) FROM given_supplier")
    assert any("M83513/101-" in str(x) for x in same(spark, "j_variants", folder, con))


def test_fives_that_are_not_whole(spark, tmp_path):
    """The last documents of a table, and others, lack some of their five."""
    folder, con = tables(tmp_path, documents="SELECT * FROM given_documents WHERE doc_id < 147 AND doc_id NOT IN (3, 5, 11, 14, 15, 16, 17, 18)")
    assert con.execute("SELECT max(doc_id) FROM documents").fetchone()[0] % 5 == 1
    same(spark, "k_dependent_moves", folder, con)


def test_gap_runs_move_rows_once(spark):
    """Repeated values give the same runs, without a step of their own."""
    from sheetforge.operators import relational

    df = spark.createDataFrame([(1, v) for v in (3, 3, 3, 9, 9, 1, None)], "k int, v int")
    runs = relational.gap_runs(df, "k", "v")
    assert sorted(map(tuple, runs.collect())) == [(1, 2, 2), (1, 4, 8)]
    assert runs._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 0 and runs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1


def test_parity_has_no_row_for_each_document_and_fact(spark, tmp_path):
    """Ten thousand documents by ten thousand facts of a profile are counted, not spelled out."""
    from pyspark.sql import functions as F

    from sheetforge.operators import quality, torque

    resolved = spark.range(100_000).select(F.concat(F.lit("S"), "id").alias("spec_sheet"), F.when(F.col("id") % 2 == 0, "05").otherwise("08").alias("slash_sheet"), F.lit(1).alias("profile_id"))
    profiles = spark.createDataFrame([(1, True)], "profile_id int, is_active boolean")
    facts = spark.range(100_000).select(F.lit(1).alias("profile_id"), F.col("id").alias("fact_key"))
    found = torque.effective_by_sheet(resolved, profiles, facts, quality.PARITY_FACTS)
    assert sorted(map(tuple, found.collect())) == [(s, 5_000_000_000, None) for s in ("05", "08")]
    few = torque.effective_by_sheet(resolved, profiles, facts.where("fact_key < 6"), quality.PARITY_FACTS)
    assert sorted(map(tuple, few.collect())) == [(s, 300_000, list(range(6))) for s in ("05", "08")]


def test_facts_of_one_profile_are_dealt(spark, monkeypatch):
    """A profile's rows come from many tasks, each document with every fact, repeated ones too."""
    from pyspark.sql import functions as F

    from sheetforge.operators import torque

    monkeypatch.setattr(torque, "PACK", 10)
    monkeypatch.setattr(torque, "PER_TASK", 1000)
    resolved = spark.range(100).select(F.col("id").alias("spec_sheet"), F.lit(1).alias("profile_id"))
    profiles = spark.createDataFrame([(1, True), (2, True)], "profile_id int, is_active boolean")
    facts = spark.range(200).select(F.lit(1).alias("profile_id"), F.floor(F.col("id") / 2).alias("fact_key"))
    out = torque.effective(resolved, profiles, facts)
    each = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(each) == 20_000 and len(each) > 4 and max(each) < 10_000
    assert {tuple(x) for x in out.groupBy("fact_key").count().collect()} == {(i, 200) for i in range(100)}


def test_service_sorts_a_question_once(spark, tmp_path):
    """Forty pages of a file in another order: rows are found and sorted once, and again when the file is another one."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from sheetforge.queries.served import Service
    from sheetforge.sources import rest

    written = []

    class Counting(Service):
        def _written(self, *a):
            written.append(1)
            return super()._written(*a)

    ids = [i * 7919 % 2003 for i in range(2003)]
    pq.write_table(pa.table({"id": ids, "v": [f"v{i % 5}" for i in ids]}), f"{tmp_path}/things.parquet")
    service = Counting(str(tmp_path))
    try:
        read = lambda: sorted(map(tuple, rest.rest_table(spark, service.url, "things", "id long, v string", order="id", pageSize=40).where("v != 'v1'").collect()))
        assert read() == [(i, f"v{i % 5}") for i in range(2003) if i % 5 != 1] and len(service.requests) > 40 and len(written) == 2
        pq.write_table(pa.table({"id": [4, 6, 5], "v": ["v4", "v1", "v0"]}), f"{tmp_path}/things.parquet")
        assert read() == [(4, "v4"), (5, "v0")]
    finally:
        service.close()


def test_lists_are_dealt_by_the_number_of_rows(spark, tmp_path, monkeypatch):
    """A list that every row is in lies in as many files as the rows ask for; rows that repeat an id count once."""
    from pyspark.sql import functions as F

    from sheetforge.operators import inverted

    monkeypatch.setattr(inverted, "PER_TASK", 50)
    monkeypatch.setattr(inverted, "PER_FILE", 25)
    rows = spark.range(1000).select((F.col("id") % 800).alias("id"), F.lit("abc").alias("a"), F.lit("xABC").alias("b"))
    index = inverted.substring_index(rows, "id", ["a", "b"], str(tmp_path), buckets=2)
    assert index.lengths(["abc", "xab"]) == {"abc": 800, "xab": 800} and index.ids("abc").count() == 800
    assert index.ids("abc").select(F.input_file_name()).distinct().count() > 8
    assert inverted.search_substring(rows, "id", ["a", "b"], index, "XAB").count() == 1000


def test_records_are_made_by_tasks_that_follow_the_pages(spark, monkeypatch):
    """No task gets much more than PAGES pages, whatever Spark makes of their compressed size."""
    from sheetforge.plans import extraction

    monkeypatch.setattr(extraction, "PAGES", 20)
    out = QUERIES["x_document_records"](spark, FOLDER)
    per = [n for n in out.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    assert sum(per) == 200 and len(per) > 20 and max(per) <= 20


@pytest.mark.parametrize("name, most", [("a_mate_family", 0.25), ("j_mates", 0.25), ("f_reasons", 0.25)])
def test_mates_are_made_by_tasks_that_follow_the_pairs(spark, tmp_path, monkeypatch, name, most):
    """Each task has a small part of the rows, though Spark would put these few bytes into one; the rows are those of the SQL."""
    from pyspark.sql import functions as F

    from sheetforge.operators import search

    folder, con = tables(tmp_path, part="SELECT * REPLACE (p_partkey + 1000 * i AS p_partkey, p_size % 5 AS p_size) FROM given_part, range(4) t(i)")
    monkeypatch.setattr(search, "PAIRS", 500)
    same(spark, name, folder, con)
    per = [r["n"] for r in QUERIES[name](spark, folder).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per) > 12 and max(per) < most * sum(per)


def test_gaps_lie_in_blocks_that_a_file_stores_small(spark, tmp_path, monkeypatch):
    """Neighbouring keys' equal values lie together, in tasks that follow the rows, and the file is a small part of eight bytes a row; the rows are those of the SQL."""
    from sheetforge.operators import relational

    monkeypatch.setattr(relational, "GAP_ROWS", 100_000, raising=False)
    held = "SELECT * REPLACE ((l_linenumber * 7919 + l_orderkey * 31) % 2000 - 1000 AS l_partkey, l_orderkey % 400 AS l_suppkey) FROM given_lineitem"
    folder, con = tables(tmp_path, lineitem=held)
    same(spark, "j_anti_gaps", folder, con)
    out = QUERIES["j_anti_gaps"](spark, folder)
    out.write.parquet(f"{tmp_path}/out")
    files = [f"{tmp_path}/out/{x}" for x in os.listdir(f"{tmp_path}/out") if x.endswith(".parquet")]
    assert sum(map(os.path.getsize, files)) < out.count() and len(files) > 6


def test_reasons_of_one_profile_are_dealt(spark, tmp_path, monkeypatch):
    """All sources have one profile, whose pairs are cut into tiles on both sides; packs of ids lose and repeat none."""
    from pyspark.sql import functions as F

    from sheetforge.operators import search

    one = "SELECT * REPLACE (84 * (p_partkey + 1000 * i) + 1 AS p_partkey, 'Brand#' || (1 + p_partkey % 2) AS p_brand, 1::INT AS p_size) FROM given_part, range(4) t(i)"
    folder, con = tables(tmp_path, part=one)
    monkeypatch.setattr(search, "SPELLED", 4000, raising=False)
    monkeypatch.setattr(search, "PACK", 7, raising=False)
    pairs = sum(same(spark, "f_reasons", folder, con).values())
    per = [r["n"] for r in QUERIES["f_reasons"](spark, folder).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per) == pairs > 100_000 and len(per) > 12 and max(per) < 0.25 * pairs


def test_reasons_of_parts_without_an_id(spark):
    """A part without an id is a source and a mate as any other."""
    from sheetforge.operators import search

    row = lambda k, sheet, mate, shell, revision: (k, sheet, 9, shell, "Plug", "Pin", revision, [mate])
    parts = [row(None, "01", "MIL-DTL-83513/2", None, "A"), row("b", "02", "MIL-DTL-83513/1", "B", ""), row(None, "02", "MIL-DTL-83513/7", None, None)]
    df = spark.createDataFrame(parts, "config_id string, slash_sheet string, cavity_count int, shell_letter string, gender string, contact_type string, revision string, mates_with array<string>")
    found = sorted((str(x[0]), str(x[1]), x[2]) for x in search.mate_reasons(df, df).collect())
    both = "Listed as a mating sheet; Same cavity count"
    assert found == [("None", "None", f"{both}; Same shell size"), ("None", "b", both)]
