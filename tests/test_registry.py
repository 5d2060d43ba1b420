"""Every query with SQL agrees with DuckDB; the others return rows with a stable schema."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tabularium.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    found = duckdb.connect()
    for t in TABLES:
        found.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return found


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, db, name):
    df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(tuple(map(plain, (r[c] for c in cols))) for r in df.collect())
    if name in registry.ORACLE_SQL:
        made = db.sql(registry.ORACLE_SQL[name])
        assert sorted(made.columns) == cols
        at = [made.columns.index(c) for c in cols]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in made.fetchall())
    else:
        assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
