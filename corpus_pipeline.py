"""Documents to token ids: stages that each write Parquet which the next one reads.

1. quality classifier: documents that the line model rejects go.
2. SimHash near-dedup: of texts whose fingerprints over three-word shingles differ in two bits or fewer, and of
   chains of them, one document stays, the one of smallest id.
3. mixing: documents are drawn to the tempered shares of source, language and topic.
4. SentencePiece: each text as ids, with the round trip checked.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents, extra ones included: operators see them under numbered names, so that
none can clash with theirs. Null and empty texts, repeated rows and empty tables mean what the
operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import line_crf, mixing, sentence_pieces, simhash
from basketry.llm.scratch import written

FOLDS, HELD_OUT = 3, 1


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under numbered column names, and the number's name of each column."""
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.5 or more; labels of the held-out fold stay unread, as in the query."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = line_crf.fit_quality(docs, labels.where(line_crf.remainder("doc_id", FOLDS) != HELD_OUT))
    held, names = numbered(docs)
    scored = line_crf.with_quality(held, model, list(names.values()), names["text"])
    return scored.where(F.col("score") >= 0.5).select(*names.values()).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each component of links, as op2 has them."""
    return simhash.without_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are drawn to the target weights of op6."""
    held, names = numbered(docs)
    mixed = mixing.mix(held, id_col=names["doc_id"], text_col=names["text"], source_col=names["source"], lang_col=names["lang"])
    return mixed.where("mix_drawn").select(*names.values()).toDF(*docs.columns)


def sentence_piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, language and source with the ids of the text, their checksums and whether decoding gives the text back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentence_pieces.encoded_and_checked(docs, path, ["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing to target weights", mixing_stage),
    ("SentencePiece", sentence_piece_stage),
]

#: The stages hold a fitted model, iterated components and raking, and a tokenizer: no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
