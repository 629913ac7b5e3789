"""Shards: every row once, groups whole, slots gapless, bytes near equal."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.llm import balance
from basketry.llm.catalog import QUERIES
from tests.llm.conftest import EDGES


def hold(rows, found, shards=8):
    """The laws that any result keeps; gives the bytes of each shard."""
    text = defaultdict(list)
    for d, t in rows:
        text[d].append(t or "")
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in found) == sorted((d or -1, len(t.encode()) + 1, zlib.crc32(t.encode())) for d in text for t in text[d])
    shard_of, slots, size = defaultdict(set), defaultdict(list), [0] * shards
    for r in found:
        shard_of[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in slots)
    return size


def test_whole_table(spark, sf_dir, documents):
    size = hold(documents, QUERIES["op10_sharding"](spark, sf_dir).collect())
    assert max(size) - min(size) <= 16


def test_edge_cases(docs_of):
    found = balance.shards_by_bytes(docs_of(EDGES)).collect()
    hold(EDGES, found)
    assert balance.shards_by_bytes(docs_of(EDGES).where(F.lit(False))).count() == 0
    hold(EDGES, balance.shards_by_bytes(docs_of(EDGES), 1).collect(), 1)


def test_many_buckets_and_a_hot_group(docs_of, monkeypatch):
    monkeypatch.setattr(balance, "GROUPS_PER_BUCKET", 5)
    monkeypatch.setattr(balance, "FAN", 3)
    monkeypatch.setattr(balance, "ROWS_PER_RANGE", 20)
    rows = [(i, "t" * (i % 97)) for i in range(300)] + [(1000 + i, "hot text") for i in range(150)]
    size = hold(rows, balance.shards_by_bytes(docs_of(rows)).collect())
    assert max(size) < 1.1 * sum(size) / 8


@pytest.mark.parametrize("on_driver", [32_768, 10])
def test_a_hot_group_and_middle_groups_over_many_buckets(docs_of, monkeypatch, on_driver):
    """A middle group outweighs its bucket's share of a shard; the excesses must not add up in one shard."""
    monkeypatch.setattr(balance, "GROUPS_PER_BUCKET", 16)
    monkeypatch.setattr(balance, "LARGE", 2)
    monkeypatch.setattr(balance, "ON_DRIVER", on_driver, raising=False)
    rows = [(i, f"{i:05d}" + "s" * (i % 17)) for i in range(1600)] + [(2000 + i, f"{i:02d}" * 45) for i in range(60)] + [(3000, "h" * 2_600)]
    size = hold(rows, balance.shards_by_bytes(docs_of(rows)).collect())
    assert max(size) < 1.02 * sum(size) / 8


def test_many_levels(docs_of, monkeypatch):
    monkeypatch.setattr(balance, "GROUPS_PER_BUCKET", 5)
    monkeypatch.setattr(balance, "FAN", 3)
    rows = [(i, f"{i:03d}" * 9) for i in range(600)]
    size = hold(rows, balance.shards_by_bytes(docs_of(rows)).collect())
    assert max(size) - min(size) <= 28


def test_a_group_of_a_third_leaves_the_others_even(docs_of):
    rows = [(i, "t" * (i % 97)) for i in range(300)] + [(1000 + i, "hot text" * 20) for i in range(50)]
    size = sorted(hold(rows, balance.shards_by_bytes(docs_of(rows)).collect()))
    assert size[-1] == 50 * 161 and size[-2] - size[0] <= 97  # one of the other groups


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=40), st.integers(1, 8))
def test_differencing_keeps_sums(sizes, k):
    parts = np.zeros((len(sizes), k), np.int64)
    parts[:, 0] = sizes
    sums, places = balance.differencing(parts)
    found = np.zeros(k, np.int64)
    for size, place in zip(sizes, places):
        assert sorted(place) == list(range(k))
        found[place[0]] += size
    assert found.tolist() == sums.tolist()


def test_differencing_by_hand():
    parts = np.zeros((5, 2), np.int64)
    parts[:, 0] = [8, 7, 6, 5, 4]
    assert sorted(balance.differencing(parts)[0].tolist()) == [14, 16]


def test_no_shards(docs_of):
    with pytest.raises(ValueError):
        balance.shards_by_bytes(docs_of(EDGES), 0)
