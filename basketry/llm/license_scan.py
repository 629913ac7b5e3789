"""License scans by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of a text is joined by its hash to the places of known license texts. A match
votes for a diagonal: place in the text less place in the template. A copy of a template is one diagonal
with many votes; words put in or left out move the rest of the copy to a neighbouring diagonal. So the
diagonals of a text and a template that lie close together are merged into one span, and the span is
verified: k-grams count only if their words are equal, the words of the template that they cover must be
a given share of it, and the words of the text that they cover must be dense in the span.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Words of a gram, steps between diagonals that are merged, shares of template and of span that must be covered.
GRAM, SLACK, SHARE, DENSITY = 3, 4, 0.6, 0.5
#: Words of all templates together, at most: what is broadcast.
TEMPLATE_WORDS = 1_000_000

# Phrases whose words name a license wherever they stand.
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}

# Notices that licenses ask for, and opening clauses of short licenses.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "gpl-2.0": ["under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "gpl-3.0": [
        "licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of ASCII digits, ASCII letters (lower-cased) and everything beyond ASCII."""
    small = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _CAPITALS, _SMALL))
    return F.array_remove(F.split(small, _BETWEEN), "")


def _hash(words: Column, at: Column, k: int) -> Column:
    """Hash of the k words from ``at`` (from 0); null where fewer are left."""
    return F.when(F.size(words) >= at + k, F.xxhash64(*(F.get(words, at + i) for i in range(k))))


def template_grams(spark: SparkSession, templates: Mapping[str, Sequence[str]], k: int) -> DataFrame:
    """One row per distinct gram hash: (key, hits), the places (template, label, n, at, gram) that hold it.

    ``n`` is the template's number of words. Templates shorter than a gram are an error.
    """
    given = [(i, label, text) for i, (label, text) in enumerate((label, t) for label, texts in sorted(templates.items()) for t in texts)]
    size = sum(len(text) for _, _, text in given)
    if size > 16 * TEMPLATE_WORDS:
        raise ValueError(f"templates of {size} characters; they are broadcast, so at most {16 * TEMPLATE_WORDS} are allowed")
    held = spark.createDataFrame(given, "template int, label string, text string").withColumn("w", words_of(F.col("text")))
    n = F.size("w")
    held = held.withColumn("n", F.when(n >= k, n).otherwise(F.raise_error(F.concat(F.lit("template too short: "), "text"))))
    placed = held.select("template", "label", "n", "w", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("at"))
    placed = placed.select(_hash(F.col("w"), F.col("at"), k).alias("key"), F.struct("template", "label", "n", "at", F.slice("w", F.col("at") + 1, k).alias("gram")).alias("hit"))
    return placed.groupBy("key").agg(F.collect_list("hit").alias("hits"))


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = GRAM,
    slack: int = SLACK,
    density: float = DENSITY,
) -> DataFrame:
    """One row per row of docs: id, n_words, places and spans.

    ``places``: array of (start, label), every place where the words of a phrase follow each other.
    ``spans``: array of (start, end, label, share), word ranges that hold part of a template in its order,
    ``share`` of whose words they cover; both arrays sorted. Words count from 0, ``end`` is exclusive.

    Null and empty texts have no words and empty arrays. Repeated rows and rows without id come out one
    by one; an empty table gives no rows; of a very long text only its matches leave the task that reads
    it. Other columns are ignored, so their names cannot clash.
    """
    w, pos = F.col("w"), F.col("pos")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words_of(F.coalesce(text_col, F.lit(""))).alias("w"))
    placed = texts.select("row", "id", "w", F.posexplode_outer("w").alias("pos", "word"))
    named = [(label, phrase.split()) for label, phrase in sorted(phrases.items())]
    here = lambda p: reduce(Column.__and__, [F.col("word") == p[0], *(F.get(w, pos + i) == x for i, x in enumerate(p) if i)])
    # Up to the shuffle there is no lambda: a lambda ends code generation, and every word would be copied out with its text.
    none = F.array().cast("array<string>")
    labels = F.concat(*(F.when(here(p), F.array(F.lit(label))).otherwise(none) for label, p in named))
    opens = F.col("word").isin(*sorted({p[0] for _, p in named}))
    said = placed.withColumn("said", F.when(opens, labels)).withColumn("key", _hash(w, pos, k))
    # At most TEMPLATE_WORDS rows are broadcast; the join is one to one, its hits come out below.
    met = said.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "key", "left")
    met = met.where(F.coalesce(pos, F.lit(0)).eqNullSafe(0) | F.col("hits").isNotNull() | (F.size("said") > 0))
    gram = F.when(F.col("hits").isNotNull(), F.slice(w, pos + 1, k))
    kept = met.select("row", "id", F.size("w").cast("long").alias("n"), pos.cast("long").alias("pos"), "said", gram.alias("gram"), "hits")
    # Everything below groups by row and more, so this is the only shuffle: one small row per text and per match.
    hits = kept.repartition("row").select("row", "id", "n", "pos", "said", "gram", F.posexplode_outer("hits").alias("i", "hit"))
    true = lambda c: F.when(F.col("hit.gram") == F.col("gram"), F.col(f"hit.{c}"))
    hits = hits.select(
        "row", "id", "n", "pos", F.when(F.coalesce("i", F.lit(0)) == 0, F.col("said")).alias("said"),
        true("template").alias("template"), true("label").alias("label"), true("n").alias("size"), true("at").cast("long").alias("at"),
    )
    places = F.flatten(F.collect_list(F.transform("said", lambda x: F.struct(F.col("pos").alias("start"), x.alias("label")))))
    diagonals = hits.groupBy("row", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.first("id").alias("id"), F.first("n").alias("n"), F.first("label", True).alias("label"), F.first("size", True).alias("size"),
        places.alias("places"), F.collect_list("at").alias("at"),
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > slack, F.lit(False))
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("island", F.sum("apart").over(along))
    covered = lambda starts: F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + k - 1))))
    spans = merged.groupBy("row", "template", "island").agg(
        F.first("id").alias("id"), F.first("n").alias("n"), F.first("label", True).alias("label"), F.first("size", True).alias("size"),
        F.flatten(F.collect_list("places")).alias("places"), F.flatten(F.collect_list("at")).alias("at"),
        F.flatten(F.collect_list(F.transform("at", lambda a: a + F.col("diagonal")))).alias("start"),
    )
    spans = spans.withColumn("covered", F.size(covered(F.col("at")))).withColumn("held", covered(F.col("start")))
    first, end = F.array_min("held"), F.array_max("held") + 1
    dense = F.size("held") >= (end - first) * F.lit(density)
    span = F.struct(first.alias("start"), end.alias("end"), "label", (F.col("covered") / F.col("size")).alias("share"))
    return spans.groupBy("row").agg(
        F.first("id").alias(id_col), F.first("n").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("places"))).alias("places"),
        F.array_sort(F.collect_list(F.when(F.col("template").isNotNull() & dense, span))).alias("spans"),
    ).drop("row")


def license_labels(scanned: DataFrame, share: float = SHARE) -> DataFrame:
    """Digest of ``license_scan``: its id and n_words, n_base, first_word, last_word, base_labels, labels and score.

    A span names its label if it covers ``share`` of its template. The score is the largest share of a
    template that was found in its order; a phrase is found whole or not at all.
    """
    ident = scanned.columns[0]
    said = F.col("places.label")
    full = F.transform(F.filter("spans", lambda s: s["share"] >= share), lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.col("spans.share")), F.lit(0.0))
    return scanned.select(
        ident, "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(said).alias("base_labels"), joined(F.concat(said, full)).alias("labels"), F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))
