"""Periodic runs of words by uniting suffix classes in descending order of their common prefixes.

The suffixes of a text are sorted by prefix doubling; neighbours in that order and the length of their
common prefix (LCP) are the edges of a graph. Kruskal's order, largest LCP first, unites classes of
suffixes; a class keeps its positions in order. When two positions i < j become neighbours within a class
at the level of an LCP of at least j - i, the words from i on repeat with period j - i: they seed a run,
which is then extended to both sides. As a smaller period would have put a position between i and j at a
higher level, every seed has the smallest period, and every run with two whole periods has a seed.

Two exact cuts keep this cheap. A run of length l and period q has the common prefix l - q, so levels below
the smallest such number are left out; and only texts with a repeated stretch of that many words, which
equal hashes tell, are sorted at all. The rest of the work is array operations over spans of texts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.llm.pieces import balanced, column_bytes, ragged

#: Words and periods that a run has at least.
LENGTH, PERIODS = 24, 3
#: Bytes of text worked on at a time; a longer text is alone, at about 60 bytes of memory per byte of it.
SPAN_BYTES = 2 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def least_level(length: int = LENGTH, periods: int = PERIODS) -> int:
    """The smallest common prefix that a run's start has with the place one period further on."""
    return min(max(length, periods * q) - q for q in range(1, length + 1))


def _starts(new: np.ndarray) -> np.ndarray:
    """For each place of a sorted array, the place where its group starts; ``new`` marks the starts after the first."""
    at = np.arange(len(new) + 1)
    at[1:][~new] = 0
    return np.maximum.accumulate(at)


class Ranks:
    """Ranks of the stretches of 1, 2, 4, ... words from every position, in their lexicographic order.

    Equal ranks of a level mean equal stretches that lie within the text. The last level tells all
    suffixes apart. A level takes 4 bytes a word; there are as many as the longest repeat has binary digits.
    """

    def __init__(self, words: np.ndarray):
        n, size = len(words), 1
        _, code, count = np.unique(words, return_inverse=True, return_counts=True)
        rank = (np.cumsum(count) - count)[code].astype(np.int32)
        self.levels = [rank]
        while len(open_ := np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)):  # the others stand where they stay
            second = np.zeros(len(open_), np.int64)
            inner = open_ + size < n
            second[inner] = rank[open_[inner] + size] + 1
            key = rank[open_].astype(np.int64) * (n + 1) + second
            order = np.argsort(key, kind="stable")
            open_, key, old = open_[order], key[order], rank[open_[order]]
            rank = rank.copy()
            rank[open_] = old + _starts(key[1:] != key[:-1]) - _starts(old[1:] != old[:-1])
            self.levels.append(rank)
            size *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words for which the suffixes at i and j (i < j) agree."""
        out, n = np.zeros(len(i), np.int64), len(self.levels[0])
        for level in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(j + out + (1 << level) <= n)
            rank, a, b = self.levels[level], (i + out)[fits], (j + out)[fits]
            out[fits[rank[a] == rank[b]]] += 1 << level
        return out

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words before i and j (i < j) that agree."""
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(i - out >= 1 << level)
            rank, a, b = self.levels[level], (i - out)[fits] - (1 << level), (j - out)[fits] - (1 << level)
            out[fits[rank[a] == rank[b]]] += 1 << level
        return out


def seeds(ranks: Ranks, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, period) of all newly adjacent positions at levels of ``words`` or more, by Kruskal's order."""
    level = min(words.bit_length() - 1, len(ranks.levels) - 1)
    shared = np.bincount(ranks.levels[level])[ranks.levels[level]] > 1
    suffixes = np.flatnonzero(shared)
    suffixes = suffixes[np.argsort(ranks.levels[-1][suffixes])]
    if len(suffixes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = np.minimum(suffixes[:-1], suffixes[1:]), np.maximum(suffixes[:-1], suffixes[1:])
    lcp = ranks.ahead(low, high)
    edges = np.flatnonzero(lcp >= words)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    root = dict.fromkeys(suffixes.tolist())
    members: dict[int, list[int]] = {}
    found: list[tuple[int, int]] = []

    def top(x: int) -> int:
        while (up := root[x]) is not None:
            if (over := root[up]) is not None:
                root[x] = over
            x = up
        return x

    for a, b, common in zip(suffixes[edges].tolist(), suffixes[edges + 1].tolist(), lcp[edges].tolist()):
        a, b = top(a), top(b)
        into, few = members.pop(a, [a]), members.pop(b, [b])
        if len(into) < len(few):
            a, b, into, few = b, a, few, into
        root[b] = a
        for x, after in zip(few, [*few[1:], None]):  # the smaller set goes into the larger: each position moves a logarithm of times
            at = bisect_left(into, x)
            if at and x - into[at - 1] <= common:
                found.append((into[at - 1], x - into[at - 1]))
            if at < len(into) and into[at] - x <= common and (after is None or into[at] < after):
                found.append((x, into[at] - x))
            into.insert(at, x)
        members[a] = into
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def runs_of(words: np.ndarray, length: int = LENGTH, periods: int = PERIODS) -> np.ndarray:
    """(start, length, period) of all runs, sorted by start and period; ``words`` are any integers."""
    ranks = Ranks(words)
    at, period = seeds(ranks, least_level(length, periods))
    start = at - ranks.behind(at, at + period)
    size = at + period + ranks.ahead(at, at + period) - start
    rows = np.unique(np.column_stack([start, period, size])[size >= np.maximum(length, periods * period)], axis=0)
    return rows[:, [0, 2, 1]]


def _may_repeat(words: np.ndarray, borders: np.ndarray, width: int) -> np.ndarray:
    """Texts (as numbers) in which some stretch of ``width`` words occurs twice, by hashes; a few more may be named."""
    n = len(words)
    if n < 2 * width:
        return np.zeros(0, np.int64)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        hashed *= np.uint64(0x100000001B3)
        hashed += mixed[i : n - width + 1 + i]
    text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    own = np.arange(n - width + 1) + width <= borders[text[: n - width + 1] + 1]
    hashed, text = hashed[own], text[: n - width + 1][own]
    hashed += text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(hashed)
    twice = (hashed[order][1:] == hashed[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.unique(text[order][1:][twice])


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words one after another, where each word begins (n + 1), a number per word, words before each text (n + 1)."""
    data, borders = column_bytes(column)
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edge = borders[:-1][np.diff(borders) > 0]
    opens[edge] = inside[edge]
    kept = np.cumsum(inside, dtype=np.int64)
    begins = kept[opens] - 1
    letters = data[inside]
    begins = np.append(begins, len(letters))
    before = np.append(0, np.cumsum(opens, dtype=np.int64))[borders]
    words = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(letters)])
    return letters, begins, words.dictionary_encode().indices.to_numpy(zero_copy_only=False), before


def _joined(letters: np.ndarray, begins: np.ndarray, chosen: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of ``counts`` words each, the chosen words joined by single spaces."""
    size = begins[chosen + 1] - begins[chosen] + 1
    out = np.full(int(size.sum()), 32, np.uint8)
    ends = np.cumsum(size)
    out[ragged(ends - size, size - 1)] = letters[ragged(begins[chosen], size - 1)]
    upto = np.append(0, ends)[np.append(0, np.cumsum(counts))]
    keep = np.ones(len(out), bool)
    keep[upto[1:][counts > 0] - 1] = False  # the space after each text's last word
    borders = upto - np.append(0, np.cumsum(counts > 0))
    return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(out[keep])])


def _kept(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, periods: int = PERIODS) -> DataFrame:
    """One row per row of docs: id, ``runs`` and ``collapsed``.

    ``runs``: array of (start, length, period), words numbered from 0, of all maximal stretches of at
    least ``length`` words and ``periods`` (2 or more) smallest periods, sorted by start and period.
    ``collapsed``: the words that no run holds after its first period, joined by single spaces.

    Words are stretches of bytes other than ASCII white space, compared as they are. Null, empty and
    blank texts have no runs and an empty ``collapsed``. Repeated rows and rows without id come out one
    by one; an empty table gives no rows. A very long text is worked on alone and whole. Other columns
    are ignored, so their names cannot clash.
    """
    if periods < 2:
        raise ValueError("a run needs at least two periods to have a seed")
    width = least_level(length, periods)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in balanced(batches, 1, SPAN_BYTES):
            letters, begins, words, before = _spans(batch.column(1))
            keep, found = np.ones(len(words), bool), [np.zeros((0, 3), np.int64)] * len(batch)
            for text in _may_repeat(words, before, width):
                lo, hi = before[text], before[text + 1]
                found[text] = runs_of(words[lo:hi], length, periods)
                keep[lo:hi] = _kept(found[text], hi - lo)
            chosen = np.flatnonzero(keep)
            counts = np.diff(np.append(0, np.cumsum(keep))[before])
            rows, ends = np.concatenate(found), np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
            held = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), held), _joined(letters, begins, chosen, counts).cast(pa.string())], ["id", "runs", "collapsed"]
            )

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(work, f"id {kind}, runs {RUNS}, collapsed string").withColumnRenamed("id", id_col)


def made_periodic(ident: Column, text: Column) -> Column:
    """The texts that the query's contract looks at: where the crc32 of the id ends in 0, words repeat from some word on."""
    h = F.crc32(ident.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1
        source = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, source(i))), " "))

    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    once = F.transform(F.array(words), repeated)[0]  # as a lambda's variable the words are split once, not for every place
    return F.when(h % 10 == 0, once).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text")))

    def stronger(a: Column, b: Column) -> Column:
        first = [(b["length"] * a["period"], a["length"] * b["period"]), (a["start"], b["start"]), (a["period"], b["period"])]
        order = F.lit(0)
        for x, y in reversed(first):
            order = F.when(x < y, -1).when(x > y, 1).otherwise(order)
        return order

    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    digest = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return digest.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
