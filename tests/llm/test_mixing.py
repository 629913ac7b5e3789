"""Raking and drawing against numpy, and the marginals themselves."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing
from basketry.llm.catalog import QUERIES

FIELDS = "doc_id long, text string, source string, lang string, mix_topic string, tokens int, w int"


def plain_rake(cells, goals, rounds=200):
    w = {k: float(t) for k, t in cells.items()}
    total = sum(w.values())
    for _ in range(rounds):
        for d, goal in enumerate(goals):
            sums = defaultdict(float)
            for k, v in w.items():
                sums[k[d]] += v
            share = sum(s for v, s in goal.items() if v in sums)
            w = {k: v * goal.get(k[d], 0) * total / share / sums[k[d]] if sums[k[d]] else 0.0 for k, v in w.items()}
    return w


def test_whole_table(spark, sf_dir, documents):
    rows = QUERIES["op6_mixing"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == [d for d, _ in documents]
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for d, t in documents}
    assert all(r["tokens"] == words[r["doc_id"]] for r in rows)
    cells = defaultdict(int)
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] += r["tokens"]
    goals = []
    for d in range(3):
        sums = defaultdict(float)
        for k, t in cells.items():
            sums[k[d]] += t
        goals.append({v: s**mixing.TEMPER for v, s in sums.items()})
        norm = sum(goals[-1].values())
        goals[-1] = {v: s / norm for v, s in goals[-1].items()}
    w = plain_rake(cells, goals)
    total = sum(cells.values())
    scale = {}
    for r in rows:
        key = r["source"], r["lang"], r["topic"]
        scale.setdefault(key, r["probability"] * r["weight"])
        assert r["probability"] * r["weight"] == scale[key] and (r["probability"] == 1 or r["weight"] == 1)
    ratio = np.array([scale[k] * cells[k] / w[k] for k in cells if w[k] > 1e-6 * total])
    assert np.allclose(ratio, ratio[0], rtol=5e-3)
    assert np.isclose(sum(r["probability"] * r["tokens"] for r in rows), mixing.KEEP * total, rtol=1e-6)
    drawn = sum(r["tokens"] for r in rows if r["drawn"])
    assert abs(drawn / total - mixing.KEEP) < 0.05


def test_given_targets_and_edge_cases(spark):
    rows = [(i, "w " * (i % 7), "abc"[i % 3], "xy"[i % 2], "t", 1, 2) for i in range(200)]
    rows += [(None, None, None, None, None, 1, 2), (5, "again", "a", "x", "t", 1, 2), (5, "again", "a", "x", "t", 1, 2), (300, "", "gone", "x", "t", 1, 2)]
    docs = spark.createDataFrame(rows, FIELDS)
    share = lambda values: spark.createDataFrame(list(values.items()), "value string, share double")
    targets = {"source": share({"a": 0.5, "b": 0.3, "c": 0.1, "": 0.1, "absent": 5.0}), "lang": share({"x": 0.6, "y": 0.3, "": 0.1})}
    found = mixing.mix(docs, targets, keep=0.5, topic=F.col("mix_topic")).collect()
    assert len(found) == len(rows)
    assert found[0].asDict().keys() == {"doc_id", "text", "source", "lang", "tokens", "w", "mix_topic", "mix_tokens", "mix_probability", "mix_weight", "mix_error", "mix_drawn"}
    mass = defaultdict(float)
    for r in found:
        mass["source", r["source"] or ""] += r["mix_tokens"] * r["mix_probability"] * r["mix_weight"]
        mass["lang", r["lang"] or ""] += r["mix_tokens"] * r["mix_probability"] * r["mix_weight"]
    total = sum(v for (d, _), v in mass.items() if d == "lang")
    for key, wanted in {("source", "a"): 0.5, ("source", "b"): 0.3, ("source", "c"): 0.1, ("lang", "x"): 0.6, ("lang", "y"): 0.3, ("source", "gone"): 0.0}.items():
        assert mass[key] / total == pytest.approx(wanted, abs=1e-3)
    assert not any(r["mix_drawn"] for r in found if r["source"] == "gone")
    assert len({r["mix_drawn"] for r in found if r["doc_id"] == 5 and r["text"] == "again"}) == 1


def test_targets_that_contradict_each_other_are_reported(spark):
    """A occurs with x only and B with y only, so the shares of both cannot be 0.9 / 0.1 and 0.2 / 0.8."""
    cells = spark.createDataFrame([("A", "x", 50), ("B", "y", 50)], "source string, lang string, tokens long")
    share = lambda values: spark.createDataFrame(list(values.items()), "value string, share double")
    found = {r["source"]: r for r in mixing.rake(cells, {"source": share({"A": 0.9, "B": 0.1}), "lang": share({"x": 0.2, "y": 0.8})}).collect()}
    assert found["A"]["w"] == pytest.approx(20) and found["B"]["w"] == pytest.approx(80)
    assert all(r["error"] > 0.5 for r in found.values())
    agreed = mixing.rake(cells, {"source": share({"A": 0.2, "B": 0.8}), "lang": share({"x": 0.2, "y": 0.8})}).collect()
    assert all(r["error"] < mixing.CLOSE for r in agreed)


def test_slow_targets_are_raked_to_the_end(spark):
    """Two nearly separate halves need far more rounds than one job makes."""
    cells = spark.createDataFrame([("A", "x", 1000), ("A", "y", 1), ("B", "x", 1), ("B", "y", 1000)], "source string, lang string, tokens long")
    share = lambda values: spark.createDataFrame(list(values.items()), "value string, share double")
    found = mixing.rake(cells, {"source": share({"A": 0.7, "B": 0.3}), "lang": share({"x": 0.6, "y": 0.4})}).collect()
    total = sum(r["w"] for r in found)
    assert sum(r["w"] for r in found if r["source"] == "A") / total == pytest.approx(0.7, abs=1e-3)
    assert sum(r["w"] for r in found if r["lang"] == "x") / total == pytest.approx(0.6, abs=1e-3)


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], FIELDS)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op6_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_topics_of_forms(spark):
    texts = {"empty": " ", "table": "a | b | c | d", "figures": "in 1998 and 2004 it was", "list": "one\ntwo\nthree", "prose": "word " * 40, "speech": "Who? Me! " + "x" * 90}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    assert all(r[0] == r[1] for r in df.select("name", mixing.form_topic(F.col("text"))).collect())


def test_token_estimates(spark):
    texts = ["", " ", "a", " a", "a ", " a  b\t\n", "\n\n", "a\x0bb\x0cc\rd", "é\u00a0b c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.token_estimate(F.col("text"))).collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for t in texts]
