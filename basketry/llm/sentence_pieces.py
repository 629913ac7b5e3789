"""SentencePiece models run by the tokenizers library.

The model's protobuf gives pieces, scores, kinds and the normaliser; from them a tokenizer is built:
a Unigram model with the scores, or a BPE model whose merges are ranked by the scores, both with byte
fallback; the normaliser's character map, white-space rules and the ``▁`` marker. Texts are cut where
no piece can span (see ``pieces``) and every new piece is verified against the SentencePiece library
when a worker first meets it; if the two ever differ, the library's ids count.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.pieces import PieceEncoder, balanced, ragged

MARK = "▁"
#: Threads of a task's tokenizer.
THREADS = "2"
#: Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass(frozen=True)
class PieceModel:
    """What the model file says."""

    path: str
    unigram: bool
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    unk_id: int
    unk_surface: str
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    byte_fallback: bool

    @property
    def cuttable(self) -> bool:
        """Texts may be cut at single spaces: no normalising, and no piece holds a marker after another character."""
        inner = any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds) if k in (NORMAL, USER))
        return not self.charsmap and not self.squeeze and self.dummy_prefix and not inner and USER not in self.kinds

    @cached_property
    def surfaces(self) -> list[bytes]:
        """Bytes that each id stands for."""
        of = {BYTE: lambda p: bytes([int(p[3:5], 16)]), CONTROL: lambda p: b"", UNKNOWN: lambda p: self.unk_surface.encode()}
        return [of.get(k, lambda p: p.replace(MARK, " ").encode())(p) for p, k in zip(self.pieces, self.kinds)]


def read_model(path: str) -> PieceModel:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    trainer, normalizer = proto.trainer_spec, proto.normalizer_spec
    if trainer.model_type not in (trainer.UNIGRAM, trainer.BPE):
        raise ValueError("only Unigram and BPE models are supported")
    return PieceModel(
        path, trainer.model_type == trainer.UNIGRAM, [p.piece for p in proto.pieces], [p.score for p in proto.pieces], [p.type for p in proto.pieces],
        trainer.unk_id, trainer.unk_surface, normalizer.precompiled_charsmap, normalizer.add_dummy_prefix, normalizer.remove_extra_whitespaces, trainer.byte_fallback,
    )


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others, the piece of best score first."""
    ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (NORMAL, USER)}
    ways = [(-model.scores[i], ids[p[:at]], ids[p[at:]], p, at) for p, i in ids.items() for at in range(1, len(p)) if p[:at] in ids and p[at:] in ids]
    return [(p[:at], p[at:]) for *_, p, at in sorted(ways)]


def build_tokenizer(model: PieceModel):
    """The tokenizers backend. Texts of a cuttable model get their opening marker from the caller."""
    from tokenizers import Regex, Tokenizer, models, normalizers

    if model.unigram:
        backend = models.Unigram(list(zip(model.pieces, model.scores)), model.unk_id, model.byte_fallback)
    else:
        backend = models.BPE({p: i for i, p in enumerate(model.pieces)}, _merges(model), unk_token=model.pieces[model.unk_id], fuse_unk=True, byte_fallback=model.byte_fallback)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix and not model.cuttable:
        steps.append(normalizers.Prepend(MARK))
    tokenizer = Tokenizer(backend)
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    user = [p for p, k in zip(model.pieces, model.kinds) if k == USER]
    if user:
        tokenizer.add_tokens(user)
    return tokenizer


@lru_cache(2)
def piece_encoder(path: str, verify: bool = True) -> tuple[PieceEncoder, PieceModel]:
    """Encoder and model, kept by the Python worker from task to task."""
    os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    import sentencepiece

    model = read_model(path)
    tokenizer = build_tokenizer(model)
    library = sentencepiece.SentencePieceProcessor(model_file=path) if verify else None
    cut = model.cuttable

    def encode(texts: list[str], first: bool) -> list:
        # What follows a cut starts with its own space; an opening gets the space of the dummy prefix.
        ids = [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts] if cut and first else texts, add_special_tokens=False)]
        if library is None:
            return ids
        right = library.encode(texts if first or not cut else [t[1:] for t in texts], num_threads=int(THREADS))
        for text, a, b in zip(texts, ids, right):
            if a != b:
                raise ValueError(f"the rebuilt tokenizer gives {a} and the SentencePiece library {b} for {text[:100]!r}")
        return ids

    widths = np.array([len(s) for s in model.surfaces], np.int64) if cut else None
    return PieceEncoder(encode, cut, widths, apart=MARK), model


def decode(flat: np.ndarray, counts: np.ndarray, model: PieceModel) -> list[bytes]:
    """Texts from the ids of all rows, one after another."""
    width = np.array([len(s) for s in model.surfaces], np.int64)
    table, begins = np.frombuffer(b"".join(model.surfaces), np.uint8), np.cumsum(width) - width
    size = width[flat]
    data = table[ragged(begins[flat], size)].tobytes()
    ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))]
    rows = [data[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])]
    return [r[1:] if model.dummy_prefix and r[:1] == b" " else r for r in rows]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ids (little-endian uint32 in a binary) of each row.

    Null and empty texts have no tokens; a null id stays null; repeated rows stay repeated; an empty
    table gives no rows. Other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = piece_encoder(path)
        for batch in balanced(batches, 1):
            n, flat = encoder.tokens(batch.column(1))
            borders = pa.py_buffer((4 * np.append(0, np.cumsum(n))).astype(np.int32))
            ids = pa.Array.from_buffers(pa.binary(), len(n), [None, borders, pa.py_buffer(flat.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), ids], ["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, f"id {kind}, n_tokens long, ids binary")
    return found.withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id and text from the rows of ``encode_documents``; null ids decode to an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = read_model(path)
        for batch in balanced(batches, 1):
            rows = [np.frombuffer(v.as_py() or b"", "<u4") for v in batch.column(1)]
            texts = decode(np.concatenate(rows) if rows else np.zeros(0, np.uint32), np.array([len(r) for r in rows], np.int64), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    found = encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(work, f"id {kind}, text string")
    return found.withColumnRenamed("id", id_col)


def encoded_and_checked(docs: DataFrame, path: str, keep: list[str], text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Columns ``keep``, n_tokens, ids (if wanted), ids_crc32, decoded_crc32 and round_trip.

    Each text is encoded and decoded again in the same Arrow batch. round_trip: the decoded text equals
    the given one (false only for texts that the model itself changes, such as those with a ``▁``).
    Edge cases are those of ``encode_documents``.
    """
    names = [f"c{i}" for i in range(len(keep))]
    chosen = docs.select(F.col(f"`{text_col}`").alias("t"), *(F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in chosen.schema[1:])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, model = piece_encoder(path)
        for batch in balanced(batches, 0):
            n, flat = encoder.tokens(batch.column(0))
            flat, ends = flat.astype("<u4"), np.append(0, np.cumsum(n))
            texts = decode(flat, n, model)
            given = [t.as_py() or b"" for t in batch.column(0).cast(pa.binary())]
            made = {
                "n_tokens": pa.array(n),
                "ids": pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(flat)]),
                "ids_crc32": pa.array([crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64()),
                "decoded_crc32": pa.array([crc32(t) for t in texts], pa.int64()),
                "round_trip": pa.array([t == g for t, g in zip(texts, given)], pa.bool_()),
            }
            if not with_ids:
                del made["ids"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made.values()], [*names, *made])

    ids = "ids binary, " if with_ids else ""
    found = chosen.mapInArrow(work, f"{kinds}n_tokens long, {ids}ids_crc32 long, decoded_crc32 long, round_trip boolean")
    return found.toDF(*keep, *found.columns[len(keep) :])


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded_and_checked(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"], with_ids=False)
