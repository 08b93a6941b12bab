"""Every core query with SQL against DuckDB on the smallest tables, and the rest for rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from rosterweave.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    from pathlib import Path

    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, db, name):
    df = registry.queries()[name](spark, small)
    columns = sorted(df.columns)
    assert columns == sorted(db.sql(SQL[name]).columns)
    want = sorted(map(repr, db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["validation_log", "clusters", "merge_lists", "provenance_detail", "project_omit", "project_custom", "resume_records"])
def test_rows(spark, small, name):
    assert registry.queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["rec_id", "pos", "skill_value"]
