"""SentencePiece on the tokenizers backend against the SentencePiece library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from basketry.llm import sentence_pieces as sp
from basketry.llm.catalog import QUERIES
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_whole_table(spark, sf_dir, documents, library):
    found = {r["doc_id"]: r for r in QUERIES["op4_sentence_pieces"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    for (d, t), ids in zip(documents, library.encode([t for _, t in documents])):
        assert (found[d]["n_tokens"], found[d]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert found[d]["round_trip"] and found[d]["decoded_crc32"] == zlib.crc32(t.encode())


def test_backend_alone_agrees(documents, library):
    """Parity without the verifying step, on whole texts."""
    tokenizer = sp.build_tokenizer(sp.read_model(PATH))
    texts = [t for _, t in documents[:150]]
    assert [e.ids for e in tokenizer.encode_batch([" " + t for t in texts])] == library.encode(texts)


def test_edge_cases(docs_of, library):
    rows = [(i, t) for i, t in EDGES if i is not None and i != 4] + [(20, "a▁b"), (21, "▁"), (22, "<s> </s> <0x41>"), (23, "\x00\x01 🙂 한글")]
    encoded = sp.encode_documents(docs_of(rows), PATH)
    assert {r[0]: np.frombuffer(r["ids"], "<u4").tolist() for r in encoded.collect()} == {i: library.encode(t or "") for i, t in rows}
    decoded = {r[0]: r[1] for r in sp.decode_documents(encoded, PATH).collect()}
    assert decoded == {i: (t or "").replace("▁", " ") for i, t in rows}
    checked = {r["doc_id"]: r["round_trip"] for r in sp.encoded_and_checked(docs_of(rows), PATH, ["doc_id", "fp"]).collect()}
    assert checked == {i: i not in (20, 21) for i, _ in rows}


def test_repeated_rows_and_no_ids(docs_of):
    rows = [(None, "a b"), (None, "a b"), (1, "a b")]
    assert sp.encode_documents(docs_of(rows), PATH).count() == 3
    assert sp.encode_documents(docs_of(rows).where(F.lit(False)), PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab éß中 \n\t.▁ '1"), max_size=40))
def test_any_text(library, text):
    encoder, model = sp.piece_encoder(PATH)
    n, flat = encoder.tokens(__import__("pyarrow").array([text, "x", text]))
    want = library.encode(text)
    assert flat.tolist() == want + library.encode("x") + want
    assert sp.decode(flat, n, model)[0].decode() == text.replace("▁", " ")


def test_unigram_models_keep_their_scores():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁ab"]
    model = sp.PieceModel("", True, pieces, [0.0, -3.0, -2.0, -2.5, -6.0, -3.5], [sp.UNKNOWN, *[sp.NORMAL] * 5], 0, " ⁇ ", b"", True, False, False)
    tokenizer = sp.build_tokenizer(model)
    assert tokenizer.encode(" abab").tokens == ["▁ab", "a", "b"]  # ab as one piece scores less than a and b
    assert sp.decode(np.array([5, 2, 3]), np.array([3]), model) == [b"abab"]


def characters_only(model):
    """The library's pieces without any merge."""
    vocabulary = {p: i for i, p in enumerate(model.pieces)}
    tokenizer = Tokenizer(models.BPE(vocabulary, [], byte_fallback=True))
    tokenizer.normalizer = normalizers.Replace(" ", sp.MARK)
    return tokenizer


def test_a_difference_from_the_library_is_an_error(monkeypatch):
    """A backend without its merges: it differs, and says so instead of giving other ids."""
    monkeypatch.setattr(sp, "build_tokenizer", characters_only)
    sp.piece_encoder.cache_clear()
    try:
        encoder, _ = sp.piece_encoder(PATH)
        with pytest.raises(ValueError, match="SentencePiece library"):
            encoder.tokens(pa.array(["the president of the organisation"]))
    finally:
        sp.piece_encoder.cache_clear()
