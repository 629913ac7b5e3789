"""How far the vocabularies of the sources of a language lie apart, by Gustavson's row accumulation.

Each group (language, source) gives every kept term of its language a scaled share p >= 1, also the terms
that it lacks: these share one baseline p0. The divergence of group g from peer h sums f(p_g, p_h) over all
kept terms. The counts are indexed by term; a task holds some terms of a language and takes their groups row
by row: the row's terms look up their postings, and what each posting adds goes into one dense accumulator
over the peers. So no pair of postings is ever a row. For a pair of groups

    sum over all terms of f(p_g, p_h)
        = V f(p0_g, p0_h)
        + sum over g's terms of  f(p_g, p0_h) - f(p0_g, p0_h)
        + sum over h's terms of  f(p0_g, p_h) - f(p0_g, p0_h)
        + sum over common terms of  f(p_g, p_h) - f(p_g, p0_h) - f(p0_g, p_h) + f(p0_g, p0_h)

where the first three sums correct for the baselines and need only how often each share occurs in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.llm.pieces import balanced, column_bytes, ragged
from basketry.llm.scratch import written

SCALE, LEAST_DOCS, TERM_RANKS = 1_000_000_000, 3, 200
#: Postings that a task scatters at a time, and kept terms of a language for which sums surely fit 64 bits.
BLOCK, MOST_TERMS = 1 << 20, 300_000_000

_LETTER = np.ones(256, bool)
_LETTER[:128] = False
_LETTER[65:91] = _LETTER[97:123] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each row's value among the distinct values; null counts as empty."""
    coded = column.cast(pa.string()).fill_null("").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and documents that hold it.

    Every group has a row without a term besides, so that groups without terms are known. Terms are
    stretches of ASCII letters (lower-cased) and of everything beyond ASCII. Counts are taken in Arrow
    spans of equal bytes and added up by Spark.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in balanced(batches, 2):
            langs, lang_names = _coded(batch.column(0))
            sources, source_names = _coded(batch.column(1))
            groups, group = np.unique(langs * len(source_names) + sources, return_inverse=True)
            data, borders = column_bytes(batch.column(2))
            inside = _LETTER[data]
            opens = inside.copy()
            opens[1:] &= ~inside[:-1]
            edge = borders[:-1][np.diff(borders) > 0]
            opens[edge] = inside[edge]
            letters = _SMALL[data[inside]]
            begins = np.append(np.cumsum(inside, dtype=np.int64)[opens] - 1, len(letters))
            words = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(letters)]).dictionary_encode()
            row = np.repeat(np.arange(len(batch)), np.diff(np.append(0, np.cumsum(opens, dtype=np.int64))[borders]))
            code, width = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary)
            held, times = np.unique(row * width + code, return_counts=True)  # one per document and term
            keys, place = np.unique(group[held // max(width, 1)] * width + held % max(width, 1), return_inverse=True)
            n = np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)
            of = np.append(keys // max(width, 1), np.arange(len(groups)))
            terms = pa.concat_arrays([words.dictionary.take(pa.array(keys % max(width, 1))).cast(pa.string()), pa.nulls(len(groups), pa.string())])
            yield pa.RecordBatch.from_arrays(
                [lang_names.take(pa.array(groups[of] // len(source_names))), source_names.take(pa.array(groups[of] % len(source_names))), terms,
                 pa.array(np.append(n, np.zeros(len(groups), np.int64))), pa.array(np.append(np.bincount(place, minlength=len(keys)), np.zeros(len(groups), np.int64)))],
                ["lang", "source", "term", "n", "docs"],
            )

    chosen = docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    counted = chosen.mapInArrow(work, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str):
    """1 + floor(SCALE (count + 1) / (total + terms)), exactly; the baseline of a group without terms is 1."""
    return F.expr(f"1 + coalesce(({SCALE}BD * ({count} + 1)) div nullif({total} + {terms}, 0), 0)")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); p and q are at most SCALE + 1, so squares fit 64 bits."""
    d = p - q
    return d * d // q


def _scattered(base: np.ndarray, begins: np.ndarray, peer: np.ndarray, p: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of one block of terms: (group, what it adds to its sum over each peer, what it adds to each peer's sum over it).

    ``base``: baselines of the language's groups. Postings ``begins[t]:begins[t + 1]`` of term t are (peer, p).
    """
    term = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.argsort(peer, kind="stable")
    cuts = np.flatnonzero(np.append(True, peer[order][1:] != peer[order][:-1]))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        row = order[lo:hi]
        g = int(peer[row[0]])
        out, back = np.zeros(len(base), np.int64), np.zeros(len(base), np.int64)
        zero, zero_back = _f(base[g], base), _f(base, base[g])
        for value, times in zip(*np.unique(p[row], return_counts=True)):  # against peers as if they lacked the terms
            out += times * (_f(value, base) - zero)
            back += times * (_f(base, value) - zero_back)
        size = begins[term[row] + 1] - begins[term[row]]
        met = ragged(begins[term[row]], size)
        own, other, q = np.repeat(p[row], size), peer[met], p[met]
        np.add.at(out, other, _f(own, q) - _f(own, base[other]) - _f(base[g], q) + zero[other])
        yield g, out, back


def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums (lang, g, h, v) over a task's terms. The first row of each language and part holds the baselines."""

    def emitted(lang: str, g: int, out: np.ndarray, back: np.ndarray | None = None) -> pa.RecordBatch:
        n, own = len(out), np.full(len(out), g, np.int32)
        every = np.arange(n, dtype=np.int32)
        g, h, v = (own, every, out) if back is None else (np.append(own, every), np.append(every, own), np.append(out, back))
        apart = (g != h) if back is None else (g != h) & (v != 0)
        return pa.RecordBatch.from_arrays([pa.array([lang] * int(apart.sum()), pa.string()), pa.array(g[apart]), pa.array(h[apart]), pa.array(v[apart])], ["lang", "g", "h", "v"])

    lang, base, held = None, np.zeros(0, np.int64), []

    def block() -> Iterator[pa.RecordBatch]:
        if held:
            peers, shares = zip(*held)
            begins = np.append(0, np.cumsum([len(x) for x in peers]))
            for g, out, back in _scattered(base, begins, np.concatenate(peers).astype(np.int64), np.concatenate(shares)):
                yield emitted(lang, g, out, back)
            held.clear()

    size = 0
    for batch in batches:
        for i in range(len(batch)):
            kind = batch.column(2)[i].as_py()
            peer, p = batch.column(3)[i].values.to_numpy(), batch.column(4)[i].values.to_numpy()
            if kind < 0:  # baselines, and with them the terms of the language once
                yield from block()
                lang, base, size = batch.column(0)[i].as_py(), p, 0
                if batch.column(1)[i].as_py() == 0:
                    for g in range(len(base)):
                        yield emitted(lang, g, int(peer[0]) * _f(base[g], base))
                continue
            held.append((peer, p))
            size += len(p)
            if size >= BLOCK:
                yield from block()
                size = 0
    yield from block()


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (lang, source, peer, value) for all pairs of sources of a language, and
    (lang, source, term, value, rank), the terms that a source has more of than its language, strongest first.

    Null text, language and source count as ''. Terms in fewer than ``least_docs`` documents of a language
    are left out; a language without terms gives pairs of value 0. Repeated rows are documents of their
    own; a language of one source has no pairs; an empty table gives empty tables. Long texts are counted
    whole. Other columns are ignored, so their names cannot clash.
    """
    counted = written(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    terms = counted.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= least_docs)
    terms = written(terms.drop("docs"), "terms")
    kept = counted.where("term is not null").join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "all_n")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # a row per source of the language
    groups = counted.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["size", "v", "lang_n"]).withColumn("g", number).withColumn("p0", share("0", "size", "v").cast("long"))
    groups = written(groups.withColumn("p0", F.when(F.col("v") <= MOST_TERMS, F.col("p0")).otherwise(F.raise_error(F.lit("too many terms")))), "groups")
    posted = kept.join(groups.select("lang", "source", "g", "size", "v", "lang_n"), ["lang", "source"])
    posted = written(posted.select("lang", "source", "g", "term", share("n", "size", "v").cast("long").alias("p"), share("all_n", "lang_n", "v").cast("long").alias("q")), "postings")

    parts = posted.count() // BLOCK + 1  # by the postings and not by the cluster: every part adds a sum per pair
    part = F.pmod(F.xxhash64("lang", "term"), F.lit(parts)).cast("int")
    index = posted.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p")).alias("x"))  # at most a posting per source
    index = index.select("lang", part.alias("part"), F.lit(0).alias("kind"), F.col("x.g").alias("g"), F.col("x.p").alias("p"))
    # The baselines of a language are as long as its list of sources; every part gets them.
    bases = groups.groupBy("lang").agg(F.first("v").cast("int").alias("v"), F.array_sort(F.collect_list(F.struct("g", "p0"))).alias("x"))
    bases = bases.select("lang", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(-1).alias("kind"), F.array("v").alias("g"), F.col("x.p0").alias("p"))
    dealt = index.union(bases).repartition(parts, "lang", "part").sortWithinPartitions("lang", "part", "kind")
    sums = dealt.mapInArrow(_accumulated, "lang string, g int, h int, v long")
    # Every sum of a pair fits a long, see MOST_TERMS; on the way there the parts are added as decimals.
    pairs = sums.groupBy("lang", "g", "h").agg(F.sum(F.col("v").cast("decimal(20,0)")).cast("long").alias("value"))
    names = groups.select("lang", "g", "source")
    pairs = pairs.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("peer")), ["lang", "h"])

    more = posted.where("p > q").select("lang", "source", "term", F.expr("(p - q) * (p - q) div q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return pairs.select("lang", "source", "peer", "value"), more.withColumn("rank", rank).where(F.col("rank") <= term_ranks)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, terms = source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "peer"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("peer").alias("item"), "value", rank.alias("rank"))
    return pairs.union(terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
