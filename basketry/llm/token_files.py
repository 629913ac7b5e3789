"""Token ids in files: canonical length-limited Huffman codes from global counts.

A token table is a folder with two Parquet tables:

``codes``   id, bits: the code length of every id; canonical codes follow from the lengths.
``blocks``  one row per block of whole documents, blocks in ascending id order:
            start (tokens of all blocks before it), doc_ids, counts (tokens of each document),
            marks (little-endian uint64 bit offsets of every STEP-th token), bits (the code, 32-bit
            big-endian words). A block is decoded without any other block, and any stretch between
            two marks without the rest of its block.

Parquet is the container so that files reach any store that Spark writes to, with its commit protocol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.huffman import Codebook, code_lengths
from basketry.llm.pieces import balanced, json_encoder
from basketry.llm.scratch import fresh_path, written

#: Longest code in bits, tokens between marks, and tokens after which a block is closed.
MOST_BITS, STEP, BLOCK_TOKENS = 18, 128, 1 << 18

STAGED = "part int, start long, doc_ids array<long>, counts array<long>, ids binary, seen binary, times binary"
BLOCKS = "start long, doc_ids array<long>, counts array<long>, marks binary, bits binary"


def _staged(docs: DataFrame, path: str, end_id: int | None, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Blocks of plain ids; ``part`` numbers the id ranges, ``start`` counts within a part; ``times`` counts the ids ``seen``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = json_encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        for batch in balanced(batches, 1):
            n, flat = encoder.tokens(batch.column(1))
            if end_id is not None:
                n = n + 1
                out, last = np.empty(len(flat) + len(n), np.uint32), np.cumsum(n) - 1
                body = np.ones(len(out), bool)
                body[last] = False
                out[last], out[body] = end_id, flat
                flat = out
            ends, done, at = np.cumsum(n), 0, 0
            names = batch.column(0)
            while done < len(n):  # close a block at the first document that fills it
                held = sum(map(len, ids))
                upto = min(len(n), int(np.searchsorted(ends, at + max(1, block_tokens - held))) + 1)
                doc_ids.append(names.slice(done, upto - done))
                counts.append(n[done:upto])
                ids.append(flat[at : ends[upto - 1]])
                done, at = upto, int(ends[upto - 1])
                if sum(map(len, ids)) >= block_tokens:
                    yield _block(part, start, doc_ids, counts, ids)
                    start += sum(map(len, ids))
                    doc_ids, counts, ids = [], [], []
        if doc_ids:
            yield _block(part, start, doc_ids, counts, ids)

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    return ordered.mapInArrow(encode, STAGED)


def _block(part: int, start: int, doc_ids: list, counts: list, ids: list) -> pa.RecordBatch:
    names, n, flat = pa.concat_arrays(doc_ids), np.concatenate(counts), np.concatenate(ids)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    packed = lambda values: pa.array([values.astype("<u4").tobytes()], pa.binary())
    times = np.bincount(flat, minlength=1)
    seen = np.flatnonzero(times)
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([start], pa.int64()), one(names), one(pa.array(n, pa.int64())), packed(flat), packed(seen), packed(times[seen])],
        ["part", "start", "doc_ids", "counts", "ids", "seen", "times"],
    )


def _id_counts(staged: DataFrame) -> DataFrame:
    """(id, n) over all blocks, from the blocks' own counts: the ids themselves are not read again."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for seen, times in zip(*batch.columns):
                seen, times = np.frombuffer(seen.as_buffer(), "<u4"), np.frombuffer(times.as_buffer(), "<u4")
                if len(seen) and seen[-1] >= len(total):
                    total = np.append(total, np.zeros(int(seen[-1]) + 1 - len(total), np.int64))
                total[seen] += times
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return staged.select("seen", "times").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS
) -> str:
    """Encode every text, append end_id, and write the token table to ``path``; returns the path.

    Documents follow each other in ascending id order, null ids first; rows with the same id stand
    side by side, ordered by text. A null or empty text has no tokens of its own. A very long text is
    encoded whole and stays in one block, which is then as long as the text. An empty table gives empty
    ``codes`` and ``blocks``. Other columns are ignored, so their names cannot clash. What reaches the driver is one row per distinct id (at most the
    vocabulary) and one per range partition.
    """
    spark = docs.sparkSession
    staged = written(_staged(docs, tokenizer, end_id, id_col, text_col, block_tokens), "token-ids")
    counts = np.array(sorted((r["id"], r["n"]) for r in _id_counts(staged).collect()), np.int64).reshape(-1, 2)
    ids, lengths = counts[:, 0], code_lengths(counts[:, 1], MOST_BITS)
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, lengths)], "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    sizes = staged.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).cast("long").alias("n")).orderBy("part").collect()
    before, first = 0, {}
    for row in sizes:
        first[row["part"]] = before
        before += row["n"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(ids, lengths, MOST_BITS)
        for batch in batches:
            for i in range(len(batch)):
                part, start = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                bits, marks = book.encode(np.frombuffer(batch.column(4)[i].as_buffer(), "<u4"), STEP)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first[part] + start], pa.int64()), batch.column(2).slice(i, 1), batch.column(3).slice(i, 1), pa.array([marks.astype("<u8").tobytes()], pa.binary()), pa.array([bits], pa.binary())],
                    ["start", "doc_ids", "counts", "marks", "bits"],
                )

    staged.drop("seen", "times").mapInArrow(pack, BLOCKS).write.parquet(f"{path}/blocks")
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids (little-endian uint32) per document."""
    codes = spark.read.schema("id long, bits int").parquet(f"{path}/codes").collect()
    ids, lengths = np.array([r["id"] for r in codes], np.int64), np.array([r["bits"] for r in codes], np.int64)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(ids, lengths, MOST_BITS)
        for batch in batches:
            for i in range(len(batch)):
                n = batch.column(2)[i].values.to_numpy()
                flat = book.decode(batch.column(4)[i].as_buffer(), np.frombuffer(batch.column(3)[i].as_buffer(), "<u8"), int(n.sum()), STEP)
                before = np.cumsum(n) - n
                borders = pa.py_buffer((4 * np.append(before, n.sum())).astype(np.int32))
                held = pa.Array.from_buffers(pa.binary(), len(n), [None, borders, pa.py_buffer(flat.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[i].values, pa.array(batch.column(0)[i].as_py() + before, pa.int64()), pa.array(n, pa.int64()), held], ["doc_id", "start", "n_tokens", "ids"]
                )

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = write_tokens(docs, fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
