"""SimHash against brute force over all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.llm.catalog import QUERIES
from basketry.llm.components import components
from basketry.llm import simhash
from tests.llm.conftest import EDGES


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    rows = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    values = sorted(set(fps.values()))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    array = np.array(values, np.uint64)
    for v in values:
        for w in array[np.bitwise_count(array ^ np.uint64(v)) <= 2]:
            parent[root(v)] = root(int(w))
    lowest = {}
    for d, v in sorted(fps.items()):
        lowest.setdefault(root(v), d)
    return {d: (f"{v:016x}", lowest[root(v)]) for d, v in fps.items()}


def test_whole_table(spark, sf_dir, documents):
    expected = plain_components({d: plain_fingerprint(t) for d, t in documents})
    assert {r[0]: (r[1], r[2]) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()} == expected


@pytest.mark.parametrize("part", [5, 4 << 20])
def test_edge_cases(docs_of, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART_BYTES", part)
    for _, text in EDGES:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)
    rows = [(i, t) for i, t in EDGES if i is not None]
    found = [tuple(r) for r in simhash.near_duplicates(docs_of(rows)).collect()]
    assert len(found) == len(rows)
    expected = plain_components({i: plain_fingerprint(t) for i, t in rows})
    assert {r[0]: r[1:] for r in found} == expected


def test_rows_without_id(docs_of):
    found = simhash.near_duplicates(docs_of([(None, "a b c"), (None, "x y z q"), (7, "a b c")])).collect()
    assert sorted((r[0] or 0, r[2] or 0) for r in found) == [(0, 0), (0, 7), (7, 7)]


def test_empty_table(docs_of):
    none = docs_of(EDGES).where(F.lit(False))
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.without_near_duplicates(none).count() == 0


def test_one_row_of_each_component_stays(docs_of):
    docs = docs_of([(5, "a b c d"), (3, "A b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t"), (9, None), (8, " ")])
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 8]


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.lists(st.tuples(st.integers(0, 63), st.integers(0, 63)), max_size=12), st.sampled_from([1, 2, 3, 5]))
def test_close_pairs(spark, seeds, flips, radius):
    values = set(seeds) | {(s ^ (1 << a)) ^ (1 << b) for s in seeds for a, b in flips}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    found = simhash.close_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), radius).collect()
    expected = {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert {frozenset(r) for r in found} == expected


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(500, 500), (3, 2)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 60)}}
