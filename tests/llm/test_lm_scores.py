"""Language-model scores: the base score exactly, the model's gradient, and probabilities that sum to one."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import attention, lm_scores
from basketry.llm.catalog import QUERIES
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(rows):
    count, held = Counter(), {}
    for d, t in rows:
        held[d] = d is not None and crc32(str(d).encode()) % 7 == 2
        if not held[d]:
            count.update([*words_of(t), None])
    n, v = sum(count.values()), len(count)
    out = []
    for d, t in rows:
        tokens = [*words_of(t), None]
        out.append((d, held[d], len(tokens), sum(count[w] > 0 for w in tokens), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def test_whole_table(spark, sf_dir, documents):
    expected = plain_base(documents)
    rows = sorted(QUERIES["op3_lm_scores"](spark, sf_dir).collect())
    assert [tuple(r)[:5] for r in rows] == [e[:5] for e in expected]
    np.testing.assert_allclose([r["base_score"] for r in rows], [e[5] for e in expected], rtol=1e-9)
    assert all(r["score"] < 0 for r in rows)
    # The base gives every unseen string the same share, which the model has to spell; with this few words that costs it more than it gains.
    print({held: (sum(r["score"] for r in rows if r["held_out"] == held), sum(r["base_score"] for r in rows if r["held_out"] == held)) for held in (False, True)})
    for held in (False, True):
        some = [r for r in rows if r["held_out"] == held]
        assert sum(r["score"] for r in some) > 1.15 * sum(r["base_score"] for r in some)


def test_edge_cases(docs_of, monkeypatch):
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(lm_scores, "START_STEPS", 6)
    monkeypatch.setattr(lm_scores, "GROUP_WORDS", 3)
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    found = sorted((tuple(r) for r in lm_scores.score(docs_of(EDGES), PATH).collect()), key=key)
    for r, e in zip(found, sorted(plain_base(EDGES), key=key), strict=True):
        assert r[:5] == e[:5] and r[5] == pytest.approx(e[5], rel=1e-9) and r[6] < 0
    assert lm_scores.score(docs_of(EDGES).where(F.lit(False)), PATH).count() == 0
    only_held = docs_of([(d, "a b") for d in range(60) if crc32(str(d).encode()) % 7 == 2])
    assert {(r["train_tokens"], r["base_score"], r["n_known"]) for r in lm_scores.score(only_held, PATH).collect()} == {(0, 0.0, 0)}


def streams():
    rng = np.random.default_rng(5)
    lengths = np.array([40, 1, 17, 33, 16])
    ids = rng.integers(0, 300, lengths.sum())
    return ids, np.roll(ids, -1), lengths


def classes():
    return attention.Classes.of(np.arange(300)[::-1].astype(float) ** 2, (np.arange(300) % 3 == 0).astype(float))


def test_every_position_is_scored_once():
    _, _, lengths = streams()
    keys, there, scored = attention.Windows(lengths)[:]
    at = keys[:, attention.WINDOW - attention.STEP :][scored]
    assert sorted(at.tolist()) == list(range(lengths.sum()))


def test_a_score_depends_on_what_comes_before_only():
    ids, targets, lengths = streams()
    weights = attention.start_weights()
    whole, _ = attention.log_probabilities(weights, classes(), ids, targets, lengths)
    changed = ids.copy()
    changed[30:40] = (changed[30:40] + 7) % 300
    part, _ = attention.log_probabilities(weights, classes(), changed, targets, lengths)
    same = np.isclose(whole, part)
    assert same[:30].all() and same[40:].all() and not same[30:40].all()


def test_probabilities_sum_to_one():
    ids, _, lengths = streams()
    w, c = attention.start_weights(), classes()
    each = np.array([attention.log_probabilities(w, c, ids, np.full(len(ids), t), lengths)[0] for t in range(300)])
    np.testing.assert_allclose(np.exp(each).sum(0), 1, rtol=1e-3)
    start = attention.log_probabilities(w, c, ids, ids, lengths)[1]
    np.testing.assert_allclose(np.exp(each[::3]).sum(0), np.exp(start), rtol=1e-3)


def test_unshifted_exponentials_agree(monkeypatch):
    ids, targets, lengths = streams()
    w = attention.start_weights()
    fast = attention.log_probabilities(w, classes(), ids, targets, lengths)
    monkeypatch.setattr(attention, "_bound", lambda w: 1e9)
    np.testing.assert_allclose(fast, attention.log_probabilities(w, classes(), ids, targets, lengths), rtol=1e-3, atol=1e-4)


def test_gradient_by_differences():
    ids, targets, lengths = streams()
    c = classes()
    w = {k: v.astype(np.float64) for k, v in attention.start_weights().items()}
    keys, there, use = attention.Windows(lengths)[:]
    args = c.inputs[ids][keys], there, use, c.outputs[targets][keys[:, attention.WINDOW - attention.STEP :]]
    slopes, _ = attention.gradient(w, *args)
    rng = np.random.default_rng(2)
    for name, slope in slopes.items():
        spots = np.argsort(-np.abs(slope).ravel())[:3].tolist() + rng.integers(0, slope.size, 2).tolist()
        for i in spots:
            moved = []
            for sign in (1, -1):
                v = {**w, name: w[name].copy()}
                v[name].flat[i] += sign * 1e-4
                moved.append(attention.gradient(v, *args)[1])
            assert slope.flat[i] == pytest.approx((moved[0] - moved[1]) / 2e-4, rel=2e-2, abs=1e-6), name


def test_training_lowers_the_loss():
    ids = np.tile(np.arange(12), 200)
    keys, there, use = attention.Windows(np.array([len(ids)]))[:]
    c = classes()
    drawn = c.inputs[ids][keys], there, use, c.outputs[np.roll(ids, -1)][keys[:, attention.WINDOW - attention.STEP :]]
    _, loss = attention.train(attention.start_weights(), *drawn, 150, 0.02, 1, 96)
    assert loss < 0.5


def opened(docs_of, rows):
    return [lm_scores.Chunk(r.asDict()) for r in lm_scores._chunks(docs_of(rows), PATH, "doc_id", "text", 7, 2).collect()]


def test_spellings_exclude_each_other(docs_of):
    """A spelling counts only where another word may follow: the, there and their share no probability."""
    end = lm_scores._speller(PATH)[1]
    for c in opened(docs_of, [(1, "the there"), (2, ""), (3, "their")]):
        before, ids, lengths, per_token, counts, index = c.streams(np.arange(len(c.counts)), end)
        assert lengths.sum() == len(ids) == per_token.sum() and len(per_token) == (counts + 1).sum() and len(index) == counts.sum()
        assert (ids[np.cumsum(lengths) - 1] == end).all() and (before[np.cumsum(lengths) - lengths] == end).all()


def test_groups_are_the_whole_chunk(docs_of, monkeypatch):
    monkeypatch.setattr(lm_scores, "GROUP_WORDS", 5)
    end = lm_scores._speller(PATH)[1]
    for c in opened(docs_of, [(i, "word " * (i % 9)) for i in range(30)]):
        groups = list(c.groups())
        assert np.concatenate(groups).tolist() == list(range(len(c.counts))) and len(groups) > 1
        parts = [c.streams(g, end)[:3] for g in groups]
        for whole, pieces in zip(c.streams(np.arange(len(c.counts)), end), zip(*parts)):
            assert whole.tolist() == np.concatenate(pieces).tolist()


def test_training_windows_come_from_all_of_a_text(docs_of):
    """The first and the second half of a long text use different words; both are drawn, in proportion."""
    end = lm_scores._speller(PATH)[1]
    (c,) = opened(docs_of, [(None, "alpha " * 30_000 + "omega " * 30_000)])
    classes = attention.Classes.of(np.bincount(c.ids, minlength=end + 1).astype(float), np.zeros(end + 1))
    x, *_ = lm_scores._drawn(c, end, 400, classes, np.random.default_rng(1))
    alpha = classes.inputs[c.ids[: c.sizes[0]]]
    share = np.isin(x[:, attention.WINDOW // 2], alpha).mean()
    assert len(x) == 400 and 0.4 < share < 0.6


def test_chunks_have_numbers_of_their_own(spark, monkeypatch):
    """One row an Arrow batch: many chunks in a partition."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        docs = spark.range(0, 5000, 1, 2).selectExpr("id as doc_id", "concat('w', id) as text")
        chunks = lm_scores._chunks(docs, PATH, "doc_id", "text", 7, 2)
        assert chunks.select("chunk").distinct().count() == 5000
    finally:
        spark.conf.set(key, before)


def test_share_of_the_text_so_far():
    token, counts = np.array([5, 5, 7, 5, 9, 1, 9]), np.array([4, 1])
    share, opening = lm_scores._so_far(token, counts)
    np.testing.assert_allclose(share, [0, 1, 0, 2 / 3, 0, 0, 0])
    assert opening.tolist() == [True, False, False, False, False, True, False]


def test_ids_are_counted_over_all_training_words(docs_of, monkeypatch):
    monkeypatch.setattr(lm_scores, "START_STEPS", 3)
    rows = [(None, "the " * 30_000 + "zebra quagmire"), (98, "zebra")] + [(d, f"the word and the other word {d} " * 3 + ("zebra quagmire" if d % 2 else "")) for d in range(40)] + [(None, None), (99, "")]
    chunks = lm_scores._chunks(docs_of(rows), PATH, "doc_id", "text", 7, 2)
    _, found = lm_scores.train_model(chunks, PATH, rounds=0)
    encoder, end, begins = lm_scores._speller(PATH)
    counts = np.zeros(end + 1)
    for d, t in rows:
        if d is None or crc32(str(d).encode()) % 7 != 2:
            for w in words_of(t):
                for i in encoder.tokens(pa.array([f" {w}"]))[1]:
                    counts[i] += 1
            counts[end] += 1
    expected = attention.Classes.of(counts, begins)
    assert (found.outputs == expected.outputs).all() and (found.inputs == expected.inputs).all()
    np.testing.assert_allclose(found.log_share, expected.log_share)


def test_every_training_window_is_learned_from_once(docs_of):
    """Over the rounds, the positions that count are all ids of all training texts, each once."""
    end = lm_scores._speller(PATH)[1]
    rows = [(d, " ".join(f"word{d} x{i}" for i in range(d * 7 % 90))) for d in range(60)] + [(None, "no id " * 500), (70, None)]
    for c in opened(docs_of, rows):
        known = attention.Classes.of(np.arange(end + 1.0), np.zeros(end + 1))
        identity = attention.Classes(np.arange(end + 1), np.arange(end + 1), known.log_share, known.begins)
        learned, sizes = [], 0
        for number in range(3):
            size, batches = lm_scores._every(c, end, identity, number, 3)
            sizes += size
            for x, there, use, y in batches:
                assert len(x) <= lm_scores.BATCH and x.shape[1] == attention.WINDOW
                learned += y[use].tolist()
        _, ids, *_ = c.streams(np.flatnonzero(~c.held), end)
        assert sizes == len(ids) and sorted(learned) == sorted(ids.tolist())


def test_candidates_of_the_mixture(monkeypatch):
    """Products by parts equal sums of logarithms, also for spellings beyond the range of a double."""
    monkeypatch.setattr(lm_scores, "FACTORS", 7)
    rng = np.random.default_rng(4)
    counts = np.array([30, 0, 7, 1])
    first = np.cumsum(counts + 1) - counts - 1
    n = int((counts + 1).sum())
    share, so_far, spelled = rng.random(n) * 1e-3, rng.random(n), -rng.random(n) * 40
    opening = np.isin(np.arange(n), first)
    share[3], so_far[3], spelled[3] = 0, 0, -2_000.0
    found = lm_scores._mixed(share, so_far, opening, spelled, first, lm_scores.MIXES)
    for i, (b, c) in enumerate(lm_scores.MIXES):
        plain = [(1 - c) * s if o else (1 - b - c) * s + b * f for s, f, o in zip(share, so_far, opening)]
        logs = [math.log10(p + c * math.exp(x)) if p else (x + math.log(c)) / math.log(10) for p, x in zip(plain, spelled)]
        np.testing.assert_allclose(found[:, i], np.add.reduceat(logs, first), rtol=1e-9)


def test_the_mixture_follows_from_all_training_texts(docs_of, monkeypatch):
    """One text in few repeats its words; it decides, wherever it is, as it holds most of the tokens."""
    monkeypatch.setattr(lm_scores, "START_STEPS", 6)
    monkeypatch.setattr(lm_scores, "MIXES", ((0.02, 0.05), (0.9, 0.05)))
    plain = [(d, f"a{d} b{d} c{d} d{d}") for d in range(10) if crc32(str(d).encode()) % 7 != 2]
    for d in [d for d in range(100, 140) if crc32(str(d).encode()) % 7 != 2][:3]:
        rows = [*plain, (d, "again " * 3_000 + " ".join(f"w{i} w{i}" for i in range(30)))]
        scores = {r["doc_id"]: r["score"] for r in lm_scores.score(docs_of(rows), PATH).collect()}
        monkeypatch.setattr(lm_scores, "MIXES", ((0.9, 0.05),))
        assert scores == pytest.approx({r["doc_id"]: r["score"] for r in lm_scores.score(docs_of(rows), PATH).collect()}, rel=1e-6)
        monkeypatch.setattr(lm_scores, "MIXES", ((0.02, 0.05), (0.9, 0.05)))


def test_the_tokenizer_gets_few_words_at_a_time(monkeypatch):
    """Its results are far larger than the ids; spelled in parts, the ids are those of all words at once."""
    words = [f"word{i}".encode() for i in range(30_000)] + [b"", "\u00e9".encode(), b"\xff"]
    given = []

    def encode(pieces, first):
        given.append(sum(map(len, pieces)))
        return inner(pieces, first)

    encoder = lm_scores.PieceEncoder(inner := lm_scores._speller(PATH)[0].encode, False)
    whole = encoder.tokens(pa.array([b" " + w for w in words], pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
    sizes, ids = lm_scores._spellings(lm_scores.PieceEncoder(encode, False), words)
    assert sizes.tolist() == whole[0].tolist() and ids.tolist() == whole[1].tolist()
    assert max(given) < 0.4 * sum(given)


def test_words_reach_the_tokenizer_joined():
    """A dictionary's words are spelled as they are alone, but not one by one; those that cannot be cut between go alone."""
    words = [f"word{i}".encode() for i in range(5_000)] + [w.encode() for w in ("é", "café", "x ", " x", "'s", "<|endoftext|>", "　", "日本", "a\x1cb", "\x1f", "1", "…", "\x7f")]
    inner = lm_scores._speller(PATH)[0]
    given = []

    def encode(pieces, first):
        given.append(len(pieces))
        return inner.encode(pieces, first)

    for some in (words, words[:1], [], [*words, b"\xff\xfe", b"\xe3x"]):
        given.clear()
        sizes, ids = lm_scores._spellings(lm_scores.PieceEncoder(encode, True, inner.widths), some)
        alone = [inner.encode([" " + w.decode("utf-8", "replace")], True)[0] for w in some]
        assert sizes.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]
        if some is words:
            assert sum(given) < 0.01 * len(words)


def test_words_of_many_texts(monkeypatch):
    monkeypatch.setattr(lm_scores, "PART_BYTES", 50)
    texts = ["", " ", None, "A b", "b", "  \t\nÉté Zz\x0b\x0c\r[end]", "x" * 130, "lead " * 40, "  \x1c a", " tail", "", None]
    for some in (texts, texts[::-1], [], ["", None], ["one"]):
        data, borders = lm_scores.column_bytes(pa.array(some, pa.string()))
        found, counts = lm_scores._words(data, borders)
        assert [w.decode() for w in found.to_pylist()] == [w for t in some for w in words_of(t)]
        assert counts.tolist() == [len(words_of(t)) for t in some]


@pytest.mark.parametrize("shifted", [False, True])
def test_steps_of_adam(monkeypatch, shifted):
    """The steps on weights that lie in one vector are those of plain Adam on each."""
    if shifted:
        monkeypatch.setattr(attention, "_bound", lambda w: 1e9)
    ids, targets, lengths = streams()
    keys, there, use = attention.Windows(lengths)[:]
    batch = classes().inputs[ids][keys], there, use, classes().outputs[targets][keys[:, attention.WINDOW - attention.STEP :]]
    w = {k: v.astype(np.float64) for k, v in attention.start_weights().items()}
    found, last = attention.descend(w, [batch] * 5, 0.01)
    mean, square = ({k: 0 * v for k, v in w.items()} for _ in range(2))
    for step in range(1, 6):
        slopes, loss = attention.gradient(w, *batch)
        for k, s in slopes.items():
            mean[k], square[k] = 0.9 * mean[k] + 0.1 * s, 0.99 * square[k] + 0.01 * s * s
            w[k] = w[k] - 0.01 * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    assert last == pytest.approx(loss) and all(found[k] == pytest.approx(w[k], rel=1e-6, abs=1e-9) for k in w)
