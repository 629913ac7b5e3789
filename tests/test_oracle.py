"""Every query with an SQL counterpart gives the same columns, types and rows as DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from basketry.plans.catalog import QUERIES
from basketry.plans.oracle import ORACLE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_every_oracle_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_as_oracle(key, spark, sf_dir, duck):
    df = entry_module.queries()[key](spark, sf_dir)
    cursor = duck.execute(entry_module.oracle_sql()[key])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    by_text = lambda t: [(v is not None, str(v)) for v in t]
    ours = sorted((tuple(r) for r in df.collect()), key=by_text)
    assert ours == sorted(expected, key=by_text)
    assert ours, "an empty result checks nothing"
    assert [type(v) for v in ours[-1]] == [type(v) for v in sorted(expected, key=by_text)[-1]]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_have_rows(key, spark, sf_dir):
    assert not entry_module.queries()[key](spark, sf_dir).isEmpty()
