"""Each pipeline stage against plain code on its own input, and edge cases through all of them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from basketry.llm.scratch import written
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, given, kept = docs.columns, [], []
    for name, stage in corpus_pipeline.STAGES:
        given.append(docs)
        docs = written(stage(spark, docs, sf_dir), "test-stage")
        if len(given) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        kept.append({r["doc_id"]: r for r in docs.collect()})
        assert len(kept[-1]) == docs.count() > 0

    labels = pq.read_table(f"{sf_dir}/labels.parquet").to_pydict()
    label = dict(zip(labels["doc_id"], labels["quality"]))
    all_ids = {r["doc_id"] for r in given[0].select("doc_id").collect()}
    known = [d for d in all_ids if d in label]
    assert np.mean([(d in kept[0]) == (label[d] == 1) for d in known]) > 0.97

    named = plain_components({d: plain_fingerprint(r["text"]) for d, r in kept[0].items()})
    assert set(kept[1]) == {component for _, component in named.values()}

    assert set(kept[2]) < set(kept[1])
    tokens = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert 0.85 < tokens(kept[2].values()) / tokens(kept[1].values()) < 1

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(kept[3]) == set(kept[2])
    for d, row in kept[3].items():
        ids = np.array(library.encode(kept[2][d]["text"]), "<u4")
        assert bytes(row["ids"]) == ids.tobytes() and row["ids_crc32"] == zlib.crc32(ids.tobytes()) and row["round_trip"]


def test_extra_columns_with_the_operators_own_names(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 200")
    clashing = docs.select("*", F.lit(7).alias("score"), *(F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in ("mix_tokens", "size", "shard", "ids", "fp", "row", "column0", "topic")))
    plain = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        clashing, plain = written(stage(spark, clashing, sf_dir), "clashing"), written(stage(spark, plain, sf_dir), "plain")
        assert clashing.columns == [*docs.columns, "score", "mix_tokens", "size", "shard", "ids", "fp", "row", "column0", "topic"]
        assert {tuple(r) for r in clashing.select(plain.columns).collect()} == {tuple(r) for r in plain.collect()}
    for row in clashing.collect():
        assert row["score"] == 7 and row["mix_tokens"] == f"mix_tokens-{row['doc_id']}" and row["column0"] == f"column0-{row['doc_id']}"
    last = corpus_pipeline.STAGES[-1][1]
    assert sorted(map(tuple, last(spark, clashing, sf_dir).collect())) == sorted(map(tuple, last(spark, plain, sf_dir).collect()))


def test_run_is_the_registered_query(spark, sf_dir, tmp_path):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    rows = [(1, None, None, None, 0), (2, "", "en", "s", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5), (None, "x y z w", None, "s", 7), (4, "word " * 30_000, "fr", None, 1)]
    fields = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, fields).write.parquet(f"{tmp_path}/some/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/some/labels.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert {r["doc_id"] for r in found} <= {1, 3, 4, None} and len(found) == len({r["doc_id"] for r in found}) > 1  # 1 and 2 are both blank
    spark.createDataFrame(rows, fields).where(F.lit(False)).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
