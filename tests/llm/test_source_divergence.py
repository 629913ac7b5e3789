"""Divergences against SQL on the whole table, and against sums over dense rows on hand-made groups."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import source_divergence
from basketry.llm.catalog import ORACLE, QUERIES
from tests.llm.conftest import matches_sql

FIELDS = "text string, lang string, source string, term string, n long, g int"


def plain(rows, least=3, ranks=200):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))) for text, lang, source in rows]
    held, counts, whole = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in words:
        held.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
        whole[lang].update(terms)
    pairs, own = set(), set()
    for lang, source in counts:
        kept = sorted(t for (x, t), n in held.items() if x == lang and n >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        p, q = share(counts[lang, source]), share(whole[lang])
        for other, peer in counts:
            if other == lang and peer != source:
                r = share(counts[lang, peer])
                pairs.add((lang, source, peer, sum(f(p[t], r[t]) for t in kept)))
        best = sorted((-f(p[t], q[t]), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t])[:ranks]
        own |= {(lang, source, t.decode(), -v, i) for i, (v, t) in enumerate(best, 1)}
    return pairs, own


def test_whole_table_against_sql(spark, sf_dir):
    rows = matches_sql(spark, sf_dir, QUERIES["op12_source_divergence"], ORACLE["op12_source_divergence"])
    assert {r["part"] for r in rows} == {"pair", "term"} and max(r["rank"] for r in rows) == 200


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_against_dense_rows(spark, monkeypatch, block):
    monkeypatch.setattr(source_divergence, "BLOCK", block)
    rng = random.Random(block)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(8)] + ["É", "É́", "ß", "Zz"]
    rows = []
    for lang, sources in (("en", 9), ("de", 2), ("solo", 1)):
        for s in range(sources):
            for _ in range(rng.randrange(1, 6)):
                rows.append((" ".join(rng.choice(vocabulary[: 4 + 6 * s]) for _ in range(rng.randrange(60))) + "1a-b_C", lang, f"s{s}"))
    rows += [(None, "en", "silent"), ("", None, "x"), ("only once here", None, None), (None, "none", "a"), ("", "none", "b"), ("same", "en", "s0"), ("same", "en", "s0"), ("same", "en", "s0")]
    rows += [("long word " * 40_000, "en", "long")]
    docs = spark.createDataFrame([(*r, "t", 1, 1) for r in rows], FIELDS).repartition(3)
    pairs, own = source_divergence.source_divergence(docs)
    wanted = plain(rows)
    assert {tuple(r) for r in pairs.collect()} == wanted[0] and pairs.count() == len(wanted[0])
    assert {tuple(r) for r in own.select("lang", "source", "term", "value", "rank").collect()} == wanted[1]


def test_extreme_shares(spark):
    """One word in one group, many words that occur there a single time in the other: shares from 1 to SCALE."""
    many = " ".join(f"t{a}{b}{c}".translate(str.maketrans("0123456789", "abcdefghij")) for a in range(10) for b in range(10) for c in range(10))
    rows = [("one " * 50_000, "en", "a"), (many, "en", "b"), (many, "en", "b"), (many, "en", "b"), ("one", "en", "c"), ("one", "en", "c")]
    docs = spark.createDataFrame([(*r, "t", 1, 1) for r in rows], FIELDS)
    pairs, _ = source_divergence.source_divergence(docs)
    assert {tuple(r) for r in pairs.collect()} == plain(rows)[0]


def test_empty_table(spark):
    pairs, own = source_divergence.source_divergence(spark.createDataFrame([], FIELDS))
    assert pairs.count() == own.count() == 0


def test_accumulator_has_no_pairs_of_its_own():
    base = np.array([5, 7, 9], np.int64)
    rows = list(source_divergence._scattered(base, np.array([0, 2, 3]), np.array([0, 2, 2]), np.array([50, 90, 40])))
    assert [g for g, *_ in rows] == [0, 2] and all(len(out) == len(back) == 3 for _, out, back in rows)
