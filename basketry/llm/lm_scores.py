"""Language-model scores of whole texts.

Tokens are lower-cased words and one end. The base score is an add-one unigram over the words of the
training texts. The model spells words in subword ids: a causal self-attention model gives each id its
probability in overlapping windows; a word's probability is

    a x (its share of the training tokens) + b x (its share of the text so far) + c x (probability of
    its spelling), a + b + c = 1.

A spelling ends where the next id would start a word, so spellings of different words exclude each
other and the probabilities of all words sum to one.

Texts are gathered in chunks with a dictionary of their distinct words, so that what is shuffled is a
row per distinct word and chunk, not per word, and a word is spelled in ids once per chunk. The attention
starts from one task's training on windows of a few chunks; these are first values only. Then the chunks
train it in rounds, each from the averaged weights of the round before. The training texts of a chunk are
dealt to the rounds, and every window of a round's texts is in exactly one step. So every id of every
training text is learned from. The texts are scored with all candidates for the weights a, b, c; those under
which all training texts are likeliest, with each word's own occurrence taken out of its count, are kept.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.llm.attention import STEP, WINDOW, Classes, Windows, descend, log_probabilities, start_weights, train
from basketry.llm.pieces import PieceEncoder, balanced, column_bytes, give_back, json_encoder, ragged
from basketry.llm.scratch import written
from basketry.llm.simhash import PART_BYTES, _SPACE

#: Text of a chunk in bytes, rounds of training, and the rate.
CHUNK_BYTES, ROUNDS, RATE = 4 << 20, 2, 0.004
#: Windows of a step. Chunks, Adam steps and rate of the start.
BATCH, START_CHUNKS, START_STEPS, START_RATE = 96, 24, 1_500, 0.015
#: Words of a chunk's dictionary that are spelled at a time, and words that are scored at a time.
SPELLED_WORDS, GROUP_WORDS = 8_000, 100_000
#: Candidates for the weights b and c of the mixture. Tokens whose probabilities are multiplied before a logarithm is taken.
MIXES = tuple((b, c) for b in (0.02, 0.05, 0.1, 0.15, 0.2, 0.3) for c in (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5))
FACTORS = 512
#: Averages of weights that reach the driver.
AVERAGES = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), [*range(9, 14), 32])

CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, counts array<long>, words binary, index binary, sizes binary, ids binary"


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _words(data: np.ndarray, borders: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of texts that lie one after another, and how many each text has. Long texts are split a part at a time, cut at white space."""
    counts, found, at = np.zeros(len(borders) - 1, np.int64), [pa.array([], pa.large_binary())], 0
    while at < len(data):
        space = _SPACE.search(data, at + PART_BYTES)
        upto = space.start() if space else len(data)
        part = data[at:upto]
        word, opens = ~_BLANK[part], np.zeros(len(part) + 1, bool)
        opens[borders[(borders >= at) & (borders <= upto)] - at] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | opens[1:-1]
        last[:-1] &= ~word[1:] | opens[1:-1]
        starts = np.flatnonzero(first)
        offsets = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - starts))
        found.append(pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[part[word]])]))
        counts += np.diff(np.searchsorted(starts + at, borders))
        at = upto
    return pa.concat_arrays(found), counts


def _spellings(encoder: PieceEncoder, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word after a space, and all ids. Some words at a time, as the tokenizer's results are far larger than their ids."""
    sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for lo in range(0, len(words), SPELLED_WORDS):
        found = encoder.spaced(words[lo : lo + SPELLED_WORDS])
        sizes.append(found[0])
        ids.append(found[1])
    return np.concatenate(sizes), np.concatenate(ids)


def _chunks(docs: DataFrame, path: str, id_col: str, text_col: str, folds: int, fold: int) -> DataFrame:
    """Documents as indexes into a chunk's list of distinct words; ``words`` are joined by line feeds.

    ``ids`` are the subword ids of all these words one after another, ``sizes`` how many each has.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, (encoder, _, _) = TaskContext.get().partitionId(), _speller(path)
        for number, batch in enumerate(balanced(batches, 1, CHUNK_BYTES)):
            found, counts = _words(*column_bytes(batch.column(1)))
            coded = found.dictionary_encode()
            held = [i is not None and crc32(str(i).encode()) % folds == fold for i in batch.column(0).to_pylist()]
            known = coded.dictionary.to_pylist()
            words = np.frombuffer(b"\n".join(known), np.uint8)
            sizes, ids = _spellings(encoder, known)
            one = lambda v, kind: pa.array([v], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number], pa.int64()), one(batch.column(0).to_pylist(), pa.int64()), one(held, pa.bool_()), one(counts, pa.int64()),
                 pa.array([_pack(words)], pa.binary()), pa.array([_pack(coded.indices.to_numpy().astype("<i4"))], pa.binary()),
                 pa.array([_pack(sizes.astype("<i4"))], pa.binary()), pa.array([_pack(ids.astype("<i4"))], pa.binary())],
                ["chunk", "doc_ids", "held", "counts", "words", "index", "sizes", "ids"],
            )
            del found, coded, known, words, sizes, ids
            give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(work, CHUNK)


class Chunk:
    """One row of the chunk table, opened."""

    def __init__(self, row: dict):
        self.chunk, self.doc_ids = row["chunk"], row["doc_ids"]
        self.held, self.counts = np.array(row["held"], bool), np.array(row["counts"], np.int64)
        self.index = _unpack(row["index"], "<i4")
        self.sizes, self.ids = _unpack(row["sizes"], "<i4").astype(np.int64), _unpack(row["ids"], "<i4")
        self.packed = row["words"]

    def words(self) -> list[bytes]:
        return zstandard.decompress(self.packed).split(b"\n") if len(self.index) else []

    def train_counts(self) -> np.ndarray:
        return np.bincount(self.index[np.repeat(~self.held, self.counts)], minlength=len(self.sizes))

    def streams(self, texts: np.ndarray, end: int) -> tuple[np.ndarray, ...]:
        """Of some texts (numbers): ids that each id follows, the ids themselves with the end, ids of each text and of each token, words and their index."""
        counts = self.counts[texts]
        index = self.index[ragged((np.cumsum(self.counts) - self.counts)[texts], counts)]
        stop = np.cumsum(counts)  # the end comes after the last word of each text
        per_token = np.insert(self.sizes[index], stop, 1)
        begins = np.insert((np.cumsum(self.sizes) - self.sizes)[index], stop, len(self.ids))
        ids = np.append(self.ids, np.int32(end))[ragged(begins, per_token)]
        after = np.append(0, np.cumsum(per_token))
        lengths = np.diff(np.append(0, after[np.cumsum(counts + 1)]))
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[np.cumsum(lengths) - lengths] = end
        return before, ids, lengths, per_token, counts, index

    def groups(self) -> Iterator[np.ndarray]:
        """Numbers of texts that follow each other, in groups of about GROUP_WORDS words; a longer text is alone."""
        ends, at = np.cumsum(self.counts), 0
        while at < len(ends):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_WORDS, side="right")))
            yield np.arange(at, upto)
            at = upto


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]
            give_back()


def _word_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, counts, fresh): training count of each dictionary word, and how many training words are first met here."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            words = c.words()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(np.full(len(words), c.chunk)), pa.array(np.arange(len(words), dtype=np.int32)), pa.array(c.train_counts(), pa.int64())], ["word", "chunk", "place", "n"]
            )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now = -1

        def close() -> pa.RecordBatch:
            place, code = (np.concatenate(x) for x in zip(*held))
            counts = np.empty(len(place), "<i8")
            counts[place] = code >> 1
            fresh = int(((code & 1) & (code > 1)).sum())
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([_pack(counts)], pa.binary()), pa.array([fresh])], ["chunk", "counts", "fresh"])

        for batch in batches:
            keys, place, code = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(keys)]):
                if held and now != keys[lo]:
                    yield close()
                    held.clear()
                now = int(keys[lo])
                held.append((place[lo:hi], code[lo:hi]))
        if held:
            yield close()

    # A word has at most one row in a chunk, so the window of the most frequent word has a row per chunk.
    same = Window.partitionBy("word")
    rows = chunks.mapInArrow(words, "word binary, chunk long, place int, n long")
    first = (F.min("chunk").over(same) == F.col("chunk")).cast("long")
    coded = rows.select("chunk", "place", (F.sum("n").over(same) * 2 + first).alias("code"))
    return coded.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(gathered, "chunk long, counts binary, fresh long")


@lru_cache(1)
def _speller(path: str) -> tuple[PieceEncoder, int, np.ndarray]:
    """Encoder, the id of the end (after all others), and which ids start a word."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    end = max(vocabulary.values()) + 2  # the file's one special token follows the vocabulary
    begins = np.zeros(end + 1)
    begins[[i for t, i in vocabulary.items() if t[0] == "Ġ"]] = 1
    begins[end] = 1
    encoder = json_encoder(path)
    del vocabulary
    give_back()
    return encoder, end, begins


def _drawn(c: Chunk, end: int, n: int, classes: Classes, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """n windows from any places of the chunk's training texts, laid out for ``train``."""
    before, ids, lengths, *_ = c.streams(np.flatnonzero(~c.held), end)
    laid = Windows(lengths)
    at, there, use = laid[rng.integers(0, len(laid), n if len(laid) else 0)]
    return classes.inputs[before[at]], there, use, classes.outputs[ids[at[:, WINDOW - STEP :]]]


def _every(c: Chunk, end: int, classes: Classes, number: int, rounds: int) -> tuple[int, Iterator[tuple[np.ndarray, ...]]]:
    """Ids of a round's training texts, and all their windows in batches for ``descend``, in an order of chance."""
    before, ids, lengths, *_ = c.streams(np.flatnonzero(~c.held)[number::rounds], end)
    laid, inputs, outputs = Windows(lengths), classes.inputs[before], classes.outputs[ids]
    order = np.random.default_rng([number, c.chunk]).permutation(len(laid))

    def batches() -> Iterator[tuple[np.ndarray, ...]]:
        for lo in range(0, len(order), BATCH):
            at, there, use = laid[order[lo : lo + BATCH]]
            yield inputs[at], there, use, outputs[at[:, WINDOW - STEP :]]

    return len(ids), batches()


def _id_counts(c: Chunk, end: int) -> np.ndarray:
    """How often each id is in a chunk's training texts."""
    total = np.bincount(c.ids, weights=np.repeat(c.train_counts(), c.sizes), minlength=end + 1).astype(np.int64)
    total[end] += int((~c.held).sum())
    return total


def _some(rows: DataFrame, chunks: DataFrame, n: int) -> DataFrame:
    """The rows of n chunks, those of smallest hash. Only their n numbers are sorted and broadcast."""
    few = chunks.select("chunk").orderBy(F.xxhash64("chunk"), "chunk").limit(n)
    return rows.join(F.broadcast(few), "chunk", "left_semi")


def train_model(chunks: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[dict, Classes]:
    """Attention weights, from all windows of all training texts, and classes of ids, from all training words."""
    _, end, begins = _speller(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(end + 1, np.int64)
        for row in _rows(batches):
            total += _id_counts(Chunk(row), end)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = np.zeros(end + 1)
    for row in chunks.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        counts[row["id"]] = row["n"]
    classes, weights = Classes.of(counts, begins), start_weights()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(0)
        parts = [_drawn(Chunk(row), end, START_STEPS * BATCH // START_CHUNKS, classes, rng) for row in _rows(batches)]
        if parts:
            drawn = [np.concatenate(p) for p in zip(*parts)]
            for part in range(3):  # the rate falls in three parts
                found, _ = train(found if part else weights, *drawn, START_STEPS // 3, START_RATE / 3**part, part, BATCH)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["w"])

    first = _some(chunks, chunks, START_CHUNKS).repartition(1).mapInArrow(begin, "w binary").collect()
    weights = pickle.loads(first[0]["w"]) if first else weights
    for number in range(rounds):

        def learn(batches: Iterator[pa.RecordBatch], weights=weights, number=number) -> Iterator[pa.RecordBatch]:
            total, n = None, 0.0
            for row in _rows(batches):
                size, every = _every(Chunk(row), end, classes, number, rounds)
                if not size:
                    continue
                found, _ = descend(weights, every, RATE / (1 + number))
                total = {k: size * v + (total[k] if total else 0) for k, v in found.items()}
                n += size
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % AVERAGES], pa.int32()), pa.array([n]), pa.array([pickle.dumps(total)], pa.binary())], ["g", "n", "w"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = None, 0.0
            for row in _rows(batches):
                found = pickle.loads(row["w"])
                total = {k: v + (total[k] if total else 0) for k, v in found.items()}
                n += row["n"]
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([pickle.dumps(total)], pa.binary())], ["n", "w"])

        sums = chunks.mapInArrow(learn, "g int, n double, w binary").repartition(AVERAGES, "g").mapInArrow(average, "n double, w binary").collect()
        if not sums:
            continue
        n = sum(r["n"] for r in sums)
        found = [pickle.loads(r["w"]) for r in sums]  # at most AVERAGES
        weights = {k: (sum(f[k] for f in found) / n).astype(np.float32) for k in weights}
    return weights, classes


def _spelled(right: np.ndarray, start: np.ndarray, counts: np.ndarray, per_token: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each token's spelling, given that a token starts there."""
    at = np.cumsum(per_token) - per_token
    out = np.add.reduceat(right.astype(np.float64), at) - start[at]
    inner = np.ones(len(at), bool)  # all but the ends are followed by the start of another token
    inner[np.cumsum(counts + 1) - 1] = False
    follows = np.flatnonzero(inner)
    out[follows] += start[at[follows + 1]]
    return out


def _so_far(token: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token: share of the same word among the words before it in its text, and whether it is the first."""
    size = counts + 1
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
    word = text * (token.max(initial=0) + 1) + token
    order = np.argsort(word * len(word) + np.arange(len(word)))  # no two are equal, so that any way of sorting gives one order
    word = word[order]
    new = np.append(True, word[1:] != word[:-1])[: len(order)]
    first = np.flatnonzero(new)
    met = np.empty(len(token))
    met[order] = np.arange(len(token)) - np.repeat(first, np.diff(np.append(first, len(token))))
    return met / np.maximum(place, 1), place == 0


def _mixed(share: np.ndarray, so_far: np.ndarray, opening: np.ndarray, spelled: np.ndarray, first: np.ndarray, mixes: tuple) -> np.ndarray:
    """log10 of each text's probability under each of the mixes (texts x mixes); ``first``: where each text's tokens start.

    Probabilities are multiplied, their binary exponents added apart, so that few logarithms are taken and none
    of the products leaves the range of a double. Spellings too rare for a double are taken in logarithms.
    """
    size = np.diff(np.append(first, len(share)))
    parts = -(-size // FACTORS)
    at = ragged(np.zeros(len(first), np.int64), parts).astype(np.int64) * FACTORS + np.repeat(first, parts)
    text = np.cumsum(parts) - parts
    spell = np.exp(np.maximum(spelled, -650.0))
    so_far = np.where(opening, share, so_far)  # an opening has no text so far, its share of the training tokens stands for it
    rare = np.flatnonzero((share == 0) & (so_far == 0) & (spelled < -600))
    spell[rare] = 1.0
    owner = np.searchsorted(first, rare, side="right") - 1
    extra = np.bincount(owner, weights=spelled[rare], minlength=len(first)) / np.log(10)
    out = np.empty((len(first), len(mixes)))
    for i, (b, c) in enumerate(mixes):
        bits = ((1 - b - c) * share + b * so_far + c * spell).view(np.int64)
        exponent = np.add.reduceat((bits >> 52) - 1023, at)
        bits &= (1 << 52) - 1
        bits |= 1023 << 52
        out[:, i] = np.add.reduceat(np.log10(np.multiply.reduceat(bits.view(np.float64), at)) + exponent * np.log10(2), text) + extra
    return out


def score(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs.

    Rows whose crc32(id as text) mod ``folds`` is ``fold`` are held out of all learning; a row without id
    is not. A null text is empty: its one token is the end. Repeated rows count and come out repeatedly.
    With nothing to learn from, base_score is 0 (the only known outcome) and the untrained model scores.
    A very long text is a chunk and a group of its own and scored whole; an empty table gives no rows.
    Other columns are ignored, so their names cannot clash.
    """
    _, end, _ = _speller(path)
    chunks = written(_chunks(docs, path, id_col, text_col, folds, fold), "chunks")
    known = written(_word_counts(chunks), "word-counts")
    texts = chunks.select(F.explode(F.arrays_zip("held", "counts")).alias("t")).where("not t.held")
    ends, n = (x or 0 for x in texts.agg(F.count(F.lit(1)), F.sum("t.counts")).first())
    n, v = n + ends, (known.agg(F.sum("fresh")).first()[0] or 0) + (ends > 0)
    weights, classes = train_model(chunks, path)
    opened = chunks.join(known.select("chunk", F.col("counts").alias("known")), "chunk", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = lambda rows: pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(MIXES)).cast(pa.list_(pa.float64()))
        for row in _rows(batches):
            c = Chunk(row)
            count = _unpack(row["known"], "<i8") if row["known"] else np.zeros(0, np.int64)
            of_word = np.append(count, ends)
            for texts in c.groups():
                before, ids, lengths, per_token, counts, index = c.streams(texts, end)
                token = np.insert(index.astype(np.int64), np.cumsum(counts), len(count))
                seen = of_word[token]
                base = np.log10((seen + 1) / (n + v + 1))
                right, start = log_probabilities(weights, classes, before, ids, lengths)
                first = np.cumsum(counts + 1) - counts - 1
                rest = *_so_far(token, counts), _spelled(right, start, counts, per_token)
                scores = _mixed(seen / max(n, 1), *rest, first, MIXES)
                known_tokens = np.add.reduceat((seen > 0).astype(np.int64), first)
                learned = np.flatnonzero(~c.held[texts])
                fits = [None] * len(texts)
                if len(learned):
                    chosen = ragged(first[learned], counts[learned] + 1)
                    begins = np.cumsum(counts[learned] + 1) - counts[learned] - 1
                    fits[0] = _mixed((seen[chosen] - 1) / max(n - 1, 1), *(x[chosen] for x in rest), begins, MIXES).sum(0).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.doc_ids[i] for i in texts], pa.int64()), pa.array(c.held[texts]), pa.array(counts + 1), pa.array(known_tokens),
                     pa.array(np.full(len(first), n, np.int64)), pa.array(np.add.reduceat(base, first)), several(scores), pa.array(fits, pa.list_(pa.float64()))],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "scores", "fits"],
                )

    found = opened.mapInArrow(work, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, fits array<double>")
    found = written(found, "scores")  # under all candidates, as a text's best needs all training texts
    fits = found.where("fits is not null").agg(*(F.sum(F.col("fits")[i]).alias(str(i)) for i in range(len(MIXES)))).first()
    best = max(range(len(MIXES)), key=lambda i: fits[i] or 0.0)
    return found.withColumn("score", F.col("scores")[best]).drop("scores", "fits").withColumnRenamed("id", id_col)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, public_tokenizers.path("byte_bpe_50k.json"))
