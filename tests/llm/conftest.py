from __future__ import annotations

import pyarrow.parquet as pq
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs; other columns have names that operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, fp string, id string, n long").repartition(3)

    return make


@pytest.fixture(scope="session")
def documents(sf_dir):
    """The documents of the test tables as (doc_id, text)."""
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return sorted(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


#: Null, empty, blank, repeated, odd white space, special strings, very long.
EDGES = [
    (1, None), (2, ""), (3, "  "), (4, "a"), (4, "a"), (5, " a b"), (6, "a "), (7, "x <|endoftext|> y"), (8, "a b c　 d"), (9, "tab\tand\nline\r\n end"),
    (10, "é à «x» ’ y"), (11, "word " * 60_000), (12, "nospace" * 3_000), (None, "no id"), (13, "A B C D"), (14, "a b c d"),
]


def matches_sql(spark, sf_dir, query, sql):
    """Rows of the query, which must be those of the SQL on the same tables."""
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    wanted = con.sql(sql)
    columns = sorted(wanted.columns)
    df = query(spark, sf_dir)
    assert sorted(df.columns) == columns
    found = df.collect()
    plain = lambda row: tuple((v is None, v) for v in row)
    assert sorted(plain(r[c] for c in columns) for r in found) == sorted(plain(r) for r in wanted.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    return found
