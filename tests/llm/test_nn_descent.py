"""Approximate search against brute force: exact scores, ties, recall."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from basketry.llm.catalog import QUERIES
from basketry.llm.nn_descent import nearest

FIELDS = "vec_id long, embedding array<float>, id long, v int"


def plain(rows, k, is_query):
    """{query: [(id, score)]} of the k nearest, for rows (id, vector) of one length."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for at in np.flatnonzero([is_query(i) for i in ids.tolist()]):
        s = x @ x[at]
        order = [o for o in np.lexsort((ids, -np.round(s, 12))) if o != at][:k]
        out[int(ids[at])] = [(int(ids[o]), float(s[o])) for o in order]
    return out


def test_whole_table(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pydict()
    rows = list(zip(table["vec_id"], table["embedding"]))
    expected = plain(rows, 20, lambda i: i % 20 == 0)
    found = {}
    vector = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for r in sorted(QUERIES["op5_neighbours"](spark, sf_dir).collect()):
        assert abs(r["score"] - float(vector[r["query_id"]] @ vector[r["vec_id"]])) < 1e-12
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert found.keys() == expected.keys()
    hits = 0
    for q, rows in found.items():
        assert [r for r, *_ in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda t: (-t[2], t[1]))
        hits += len({i for _, i, _ in rows} & {i for i, _ in expected[q]})
    assert hits / (20 * len(found)) >= 0.9


def test_edge_cases(spark):
    good = [(i, [1.0, 0.5]) for i in (9, 3, 20, 4, 7)] + [(10, [0.5, -1.0]), (11, [2.0, 2.0]), (12, [-1.0, 0.0])]
    bad = [(30, None), (40, [0.0, 0.0]), (50, [None, 1.0]), (60, [float("nan"), 0.0]), (70, [float("inf"), 0.0]), (None, [1.0, 1.0]), (10, [0.5, -1.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in good + bad], FIELDS).repartition(3)
    expected = plain(good, 3, lambda i: i % 10 == 0)
    found = {}
    for r in sorted(nearest(df, 3, F.col("id") % 10 == 0, "vec_id", "embedding").collect()):
        found.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert found == expected


def test_empty_and_single(spark):
    none = spark.createDataFrame([], FIELDS)
    assert nearest(none, 3, F.lit(True), "vec_id", "embedding").count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0], 0, 0)], FIELDS), 3, F.lit(True), "vec_id", "embedding").count() == 0
