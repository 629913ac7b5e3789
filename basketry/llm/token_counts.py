"""Token counts: batch encoding in Arrow functions that return lengths only.

Arrow batches are worked through in spans of equal bytes, and long texts are cut at safe boundaries
(see ``pieces``), so a task's memory follows the span and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.pieces import PieceEncoder, balanced, json_encoder


def model_counter(path: str) -> PieceEncoder:
    """Counts of a SentencePiece model file; texts stay whole, as its normaliser may join them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return PieceEncoder(lambda texts, first: model.encode(texts, num_threads=1), cut=False)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per row of docs: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows stay repeated;
    an empty table gives no rows. Other columns are ignored, so their names cannot clash.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    # octet_length is taken in the JVM: the bytes themselves do not come back from Python.
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("b"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(path) if path.endswith(".json") else model_counter(path)
        for batch in balanced(batches, 1):
            n, _ = encoder.tokens(batch.column(1), with_ids=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "b", "n"])

    counted = chosen.mapInArrow(count, f"id {kind}, b long, n long")
    return counted.select(F.col("id").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
