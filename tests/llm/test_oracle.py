"""Queries whose results SQL can express agree with it in DuckDB, row by row."""

import duckdb
import pytest

from tabularium.llm import queries

TABLES = "documents embeddings pages".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df, made = queries.QUERIES[name](spark, sf_dir), db.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(made.columns) == cols
    at = [made.columns.index(c) for c in cols]
    told = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    got = sorted(tuple(told(r[c]) for c in cols) for r in df.collect())
    assert got and got == sorted(tuple(told(r[i]) for i in at) for r in made.fetchall())
