"""Runs against all stretches of all periods, and the whole query against its contract in plain code."""

from __future__ import annotations

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from basketry.llm.catalog import QUERIES
from basketry.llm.periodic_runs import least_level, periodic_runs, runs_of
from tests.llm.conftest import EDGES


def plain_runs(words, length=24, periods=3):
    """All maximal stretches of smallest period q, found by trying every q."""
    found = {}
    n = len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, periods * q):
                # of several periods of a stretch the smallest comes first, and it covers the multiples
                if not any(s <= i and j + q <= s + m and q % p == 0 for (s, p), m in found.items()):
                    found[i, q] = j + q - i
            i = max(j, i + 1)
    return sorted((s, m, p) for (s, p), m in found.items())


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha(b"".join(b"%d,%d,%d\n" % r for r in runs)), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < rng.choice([30, 120, 400]):
        block = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 25))]
        words += block * rng.choice([1, 1, 3, 4, 9]) + block[: rng.randrange(len(block) + 1)]
    for length, periods in ((24, 3), (4, 2), (1, 2), (10, 4)):
        found = [tuple(r) for r in runs_of(np.array(words), length, periods).tolist()]
        assert found == plain_runs(words, length, periods)


def test_level():
    assert least_level(24, 3) == 16 and least_level(1, 2) == 1


def test_edge_cases(spark, docs_of):
    line = "buy now and save more today "
    cases = [*EDGES, (20, line * 40), (21, "a " * 5 + line * 9 + "b c"), (22, ("x " * 30 + "y ") * 4), (23, "É" + " ß ü" * 30), (24, "a\tb\n" * 12), (25, "a b " * 11 + "a")]
    found = periodic_runs(docs_of(cases)).collect()
    assert len(found) == len(cases)
    wanted = sorted(((d, [(s, m, q) for s, m, q in plain_runs((t or "").encode().split()[:2000])]) for d, t in cases if d not in (11, 12)), key=str)
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]]) for r in found if r["doc_id"] not in (11, 12)), key=str) == wanted
    by_id = {r["doc_id"]: r for r in found}
    assert [tuple(x) for x in by_id[11]["runs"]] == [(0, 60_000, 1)] and by_id[11]["collapsed"] == "word"
    assert by_id[20]["collapsed"] == line.strip() and by_id[1]["collapsed"] == by_id[3]["collapsed"] == "" and by_id[9]["collapsed"] == "tab and line end"
    empty = periodic_runs(docs_of(cases).limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "runs", "collapsed"]


def test_whole_table(spark, sf_dir, documents):
    rows = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = sorted(tuple(r) for r in rows.collect())
    assert [r[0] for r in found] == [d for d, _ in documents]
    some = [(d, t) for d, t in documents if len(t.split()) < 1500]
    wanted = {d: plain_digest(d, t) for d, t in some}
    assert len(some) > 0.9 * len(documents)
    assert [r for r in found if r[0] in wanted] == [wanted[d] for d, _ in some]
    assert sum(r[1] > 0 for r in found) > 50
