"""Line features against plain code, marginals against enumeration, quality against held-out labels."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from basketry.llm import line_crf, line_features as lf
from basketry.llm.catalog import QUERIES
from tests.llm.conftest import EDGES


def plain_features(text):
    raw = text.encode()
    lines = raw.split(b"\n")
    share = lambda line, chars: sum(c in chars for c in line) / max(len(line), 1)
    kinds = [b"0123456789", bytes(range(65, 91)), b"#$%&*|<>{}[]=@^~_\\/+", b"!?", b".,;:'\"()-", b"\t\v\f\r "]
    out = []
    for line in lines:
        words = line.split()
        n = max(len(words), 1)
        out.append([
            np.log1p(len(line)), *(share(line, k) for k in kinds), np.log1p(len(words)), np.log1p(sum(map(len, words)) / n),
            sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, sum(a == b for a, b in zip(words, words[2:])) / n,
            line[-1:] in (b".", b"!", b"?") and bool(line), line[:1].isupper(), bool(line) and lines.count(line) > 1, len(lines) == 1,
        ])
    return np.array(out, np.float32), [len(x) for x in lines]


def test_features(documents):
    texts = [t for _, t in documents[:60]] + ["", "\n", "a\n", "\n\na\n", "a b a b\nA! 1\n", "x", " "]
    found, size, lines = lf.batch_lines(pa.array(texts))
    expected = [plain_features(t) for t in texts]
    assert lines.tolist() == [len(s) for _, s in expected]
    assert size.tolist() == [n for _, s in expected for n in s]
    np.testing.assert_allclose(found, np.vstack([x for x, _ in expected]), rtol=1e-5, atol=1e-6)


def test_run_hashes_do_not_depend_on_place():
    word = bytes(range(1, 200)) * 700
    data = np.frombuffer(b"xyz" + word + b"0" * 65_531 + word + word, np.uint8)
    begin = np.array([3, 3 + len(word) + 65_531, 3 + 2 * len(word) + 65_531])
    found = lf.RunHashes(data)(begin, begin + len(word))
    assert len(set(found.tolist())) == 1
    assert lf.RunHashes(data)(begin, begin + len(word) - 1)[0] != found[0]


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    lines, trans = np.array([1, 4, 2, 5, 1]), rng.normal(size=(2, 2))
    emit = rng.normal(size=lines.sum())
    good, pairs, log_z = line_crf.marginals(emit, lines, trans)
    at, all_pairs, total = 0, np.zeros((2, 2)), 0.0
    for n in lines:
        e, weight, sums, both = emit[at : at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(e[i] * y for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            weight += w
            sums += w * np.array(path)
            for a, b in zip(path, path[1:]):
                both[a, b] += w
        np.testing.assert_allclose(good[at : at + n], sums / weight)
        all_pairs += both / weight
        total += np.log(weight)
        at += n
    np.testing.assert_allclose(pairs, all_pairs)
    assert np.isclose(log_z, total)


def test_held_out_labels(spark, sf_dir):
    labels = pq.read_table(f"{sf_dir}/labels.parquet").to_pydict()
    label = dict(zip(labels["doc_id"], labels["quality"]))
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) >= 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 50
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_labels_of_held_out_rows_are_not_read(spark, docs_of):
    docs = docs_of([(i, "word " * i) for i in range(30)])
    labels = docs.select("doc_id", F.when(line_crf.remainder("doc_id", 3) == 1, F.lit(0)).otherwise(F.lit(1)).alias("quality"))
    assert line_crf.fit_quality(docs, labels.where(line_crf.remainder("doc_id", 3) != 1)).weights is None
    assert {r["predicted"] for r in line_crf.quality(docs, labels).collect()} == {1}


def test_edge_cases(spark, docs_of):
    docs = docs_of(EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in line_crf.quality(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 0), (2, 0), (4, 1), (5, 1), (13, 1), (11, 0), (None, 1), (6, None), (7, 5)], "doc_id long, quality int")
    found = line_crf.quality(docs, labels).collect()
    assert len(found) == len(EDGES) and all(0 <= r["score"] <= 1 for r in found)
    assert line_crf.quality(docs.where(F.lit(False)), labels).count() == 0
