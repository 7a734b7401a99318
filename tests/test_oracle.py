"""Every query with SQL agrees with it on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CORE = [n for n in entry.oracle_sql() if n not in getattr(entry, "LLM_NAMES", ())]


def same(value):
    if isinstance(value, float):
        return str(round(value, 6))
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def agrees(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(tuple(map(same, r)) for r in df.select(*columns).collect())
    rel = duck.execute(entry.oracle_sql()[name])
    known = [d[0] for d in rel.description]
    assert sorted(known) == columns
    at = [known.index(c) for c in columns]
    assert found == sorted(tuple(same(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if not n[:2] in {f"p{i}" for i in range(1, 10)} and not n.startswith("p10_") or n.startswith(("p2_", "p5_"))])
def test_query(spark, duck, name):
    agrees(spark, duck, name)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["run_id", "html_index"]


def test_queries_have_sql_or_reason():
    assert set(entry.oracle_sql()) <= set(entry.queries())
