"""Every catalog query against its SQL in DuckDB, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from sheetforge.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


def plain(v):
    if v is None or str(v) in ("<NA>", "NaT", "nan"):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v if not hasattr(v, "item") else plain(v.item())


def rows(frame):
    cols = sorted(frame.columns)
    return cols, Counter(tuple(plain(v) for v in r) for r in frame[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLE_SQL:
        assert len(got) >= 1
        return
    assert rows(got) == rows(db.execute(ORACLE_SQL[name]).df())


def test_plain():
    assert plain(math.nan) is None


def test_display_takes_every_line_item(spark):
    assert "where" not in ORACLE_SQL["f_display"].lower()
    assert QUERIES["f_display"](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() > 0


def test_summaries_take_every_row(spark):
    part, lineitem = (spark.read.parquet(f"{FOLDER}/{t}.parquet").count() for t in ("part", "lineitem"))
    out = QUERIES["a_verdict_summary"](spark, FOLDER).collect()
    assert sum(x["n"] for x in out) == sum(len(x["case_ids"].split(",")) for x in out) == part > 40
    assert QUERIES["q_golden"](spark, FOLDER).count() == part
    assert sum(x["wire_rows"] for x in QUERIES["a_multi_measure"](spark, FOLDER).collect()) == lineitem


def test_gaps_reach_the_largest_part(spark):
    seen = {}
    for x in spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_suppkey", "l_partkey").collect():
        seen.setdefault(x[0], set()).add(x[1])
    want = {(k, i) for k, v in seen.items() for i in range(min(v), max(v)) if i not in v}
    got = [(x["l_suppkey"], x["l_partkey"]) for x in QUERIES["j_anti_gaps"](spark, FOLDER).collect()]
    assert len(got) == len(want) and set(got) == want and max(i for _, i in want) > 40


def test_chunks_of_a_long_text(spark, tmp_path):
    """A text of more than 39 chunks."""
    docs = spark.createDataFrame([(1, "word  " * 20_000), (2, "short"), (3, "")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = rows(QUERIES["f_collapse_chunk"](spark, str(tmp_path)).toPandas())
    assert got == rows(con.execute(ORACLE_SQL["f_collapse_chunk"]).df()) and sum(got[1].values()) > 40
