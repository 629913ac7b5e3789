"""Token files and counts against the tokenizer on whole texts, and exact round trips."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.catalog import QUERIES
from basketry.llm.huffman import Codebook, code_lengths
from basketry.llm.scratch import fresh_path
from basketry.llm.token_counts import token_counts
from basketry.llm.token_files import read_tokens, write_tokens
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_files_hold_the_whole_table(spark, sf_dir, documents, ids_of):
    ids = ids_of([t for _, t in documents])
    n = np.array([len(x) + 1 for x in ids])
    expected = [(d, int(s), int(k), zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for (d, _), s, k, x in zip(documents, np.cumsum(n) - n, n, ids)]
    assert sorted(tuple(r) for r in QUERIES["op1_token_files"](spark, sf_dir).collect()) == expected


def test_counts_of_the_whole_table(spark, sf_dir, documents, ids_of):
    expected = [(d, len(t.encode()), len(x), len(x) > 512) for (d, t), x in zip(documents, ids_of([t for _, t in documents]))]
    assert sorted(tuple(r) for r in QUERIES["op8_token_counts"](spark, sf_dir).collect()) == expected


@pytest.mark.parametrize("block", [1, 50, 1 << 18])
def test_files_of_edge_cases(spark, docs_of, ids_of, block):
    path = write_tokens(docs_of(EDGES), fresh_path(spark, "test"), PATH, end_id=0, block_tokens=block)
    found = read_tokens(spark, path).orderBy("start").collect()
    rows = sorted(EDGES, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in found] == [i for i, _ in rows]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [[*x, 0] for x in ids_of([t for _, t in rows])]
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()


def test_counts_of_edge_cases(docs_of, ids_of):
    found = sorted(tuple(r) for r in token_counts(docs_of(EDGES).fillna(-1, ["doc_id"]), PATH).collect())
    expected = sorted((-1 if i is None else i, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(EDGES, ids_of([t for _, t in EDGES])))
    assert found == expected


def test_sentencepiece_counts(docs_of):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in EDGES if i is not None]
    assert sorted((r[0], r[2]) for r in token_counts(docs_of(rows), path).collect()) == sorted((i, len(model.encode(t or ""))) for i, t in rows)


def test_empty_tables(spark, docs_of):
    none = docs_of(EDGES).where(F.lit(False))
    path = write_tokens(none, fresh_path(spark, "test"), PATH)
    assert read_tokens(spark, path).count() == 0
    assert token_counts(none, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=60), st.integers(6, 18))
def test_code_lengths(counts, most):
    counts = np.array(counts)
    lengths = code_lengths(counts, most)
    assert lengths.max() <= most
    assert sum(2.0 ** -lengths) <= 1
    order = np.argsort(counts, kind="stable")
    assert (np.diff(lengths[order][::-1]) >= 0).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=900), st.sampled_from([1, 7, 128]))
def test_round_trip(values, step):
    ids = np.array(values, np.uint32)
    seen, counts = np.unique(ids, return_counts=True)
    book = Codebook(seen.astype(np.int64), code_lengths(counts, 18), 18)
    bits, marks = book.encode(ids, step)
    assert book.decode(bits, marks, len(ids), step).tolist() == values
