"""Cut texts where no token can span the cut, and encode each distinct piece once.

A single space between two characters that are not white space starts a new pre-token in the
byte-level pattern, and a new ``▁`` run in SentencePiece vocabularies whose pieces hold that marker
only in front. The ids of a text are therefore the ids of its pieces in order. Words repeat, so a
worker keeps the ids of pieces it has seen (a bounded cache) and the tokenizer sees the rest.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked up at a time; keeps the working arrays of a task small.
SPAN_BYTES = 4 << 20
#: Distinct pieces a worker keeps.
CACHE_PIECES = 500_000
#: Pieces that go to the tokenizer as one text.
JOINED = 1_000
#: Longer pieces are encoded but not kept.
CACHE_BYTES = 256

_PLAIN = np.ones(256, bool)
_PLAIN[:33] = False
_PLAIN[127] = False
_FOLLOWS = _PLAIN.copy()
_FOLLOWS[[0xC2, 0xE1, 0xE2, 0xE3]] = False  # first bytes of characters that may be white space or the marker


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 borders of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or borders[-1] == borders[0]:
        return np.zeros(0, np.uint8), borders - borders[0]
    return np.frombuffer(data, np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def piece_starts(data: np.ndarray, borders: np.ndarray, cut: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Positions where pieces start, and which of them start a text."""
    n = len(data)
    opens = np.zeros(n + 1, bool)
    opens[borders] = True
    starts = opens[:n].copy()
    if cut and n > 2:
        at = np.flatnonzero(data == 32)
        at = at[(at > 0) & (at < n - 1)]
        before = data[at - 1]
        wide = before >= 128
        wide &= (data[at - 2] == 0xC2) | ((data[at - 3] >= 0xE1) & (data[at - 3] <= 0xE3))
        safe = _PLAIN[before] & ~wide & _FOLLOWS[data[at + 1]] & ~opens[at] & ~opens[at + 1]
        starts[at[safe]] = True
    at = np.flatnonzero(starts)
    return at, opens[at]


def balanced(batches: Iterator[pa.RecordBatch], column: int, most: int = SPAN_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in batches of about ``most`` bytes of text; a longer text is alone in its batch."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(size), 0
        while at < len(size):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def give_back() -> None:
    """Return freed memory to the system. A Python worker outlives its tasks, beside a JVM that needs the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of every (start, length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0)) + total) < 2**31 else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


class PieceEncoder:
    """ids of texts, piece by piece.

    ``encode(texts, first)`` gives the ids of each text; ``first``: the texts are openings, not what
    follows a cut. ``widths`` (bytes of text behind each id) lets many pieces go to the tokenizer as
    one text, which is told apart again by the widths; that saves the cost of a call's result object.
    Pieces that hold ``apart`` always go alone.
    """

    def __init__(self, encode: Callable[[list[str], bool], list], cut: bool = True, widths: np.ndarray | None = None, apart: str = "", cache: int = CACHE_PIECES):
        self.encode, self.cut, self.widths, self.apart, self.cache = encode, cut, widths, apart, cache
        self._clear()

    def _clear(self) -> None:
        self._known = [pa.array([], pa.large_binary()), pa.array([], pa.large_binary())]  # what follows a cut, openings
        self._place = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._ids, self._begin, self._length = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encoded(self, pieces: pa.Array, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each piece, and all their ids."""
        _, borders, data = pieces.buffers()
        borders = np.frombuffer(borders, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        text = lambda lo, hi: data[lo:hi].tobytes().decode("utf-8", "replace")
        joins = np.zeros(len(pieces), bool)
        if self.widths is not None and not first:
            joins = _PLAIN[data[borders[1:] - 1]]
            if self.apart:
                joins &= ~pc.match_substring(pieces, self.apart).to_numpy(zero_copy_only=False)
        lengths, flat, order = np.zeros(len(pieces), np.int64), [np.zeros(0, np.uint32)], []
        if joins.any():
            chosen = pieces.filter(pa.array(joins))
            at = np.frombuffer(chosen.buffers()[1], np.int64)[chosen.offset : chosen.offset + len(chosen) + 1]
            held, cuts = np.frombuffer(chosen.buffers()[2], np.uint8), np.append(at[:-1:JOINED], at[-1])
            ids = self.encode([held[lo:hi].tobytes().decode("utf-8", "replace") for lo, hi in zip(cuts[:-1], cuts[1:])], False)
            ids = [np.array(x, np.uint32) for x in ids]
            reach, size = np.cumsum(self.widths[np.concatenate(ids)]), at[1:] - at[0]
            upto = np.minimum(np.searchsorted(reach, size), len(reach) - 1)
            if (reach[upto] != size).any():
                raise ValueError("a token spans a cut; this tokenizer's texts cannot be cut at spaces")
            lengths[joins] = np.diff(upto + 1, prepend=0)
            flat += ids
            order.append(np.flatnonzero(joins))
        if not joins.all():
            alone = np.flatnonzero(~joins)
            found = self.encode([text(borders[i], borders[i + 1]) for i in alone], first)
            lengths[alone] = [len(x) for x in found]
            flat += [np.array(x, np.uint32) for x in found]
            order.append(alone)
        order = np.concatenate(order)
        begins = np.empty(len(pieces), np.int64)
        begins[order] = np.cumsum(lengths[order]) - lengths[order]
        return lengths, np.concatenate(flat)[ragged(begins, lengths)]

    def spaced(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each word after a space, and all ids; nothing is kept. Words that texts can be cut between go to the tokenizer as one text."""
        pieces = pa.array([b" " + w for w in words], pa.large_binary())
        data, ends = np.frombuffer(b"\0 " + b" ".join(words), np.uint8), np.cumsum([len(w) + 1 for w in words], dtype=np.int64) + 1
        begins = np.append(2, ends[:-1] + 1)[: len(words)]
        last = data[ends - 1]
        wide = (last >= 128) & ((data[ends - 2] == 0xC2) | ((data[ends - 3] >= 0xE1) & (data[ends - 3] <= 0xE3)))
        joins = (ends > begins) & _PLAIN[last] & ~wide & _FOLLOWS[data[np.minimum(begins, len(data) - 1)]]
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:  # what stands for a wrong byte has another width
            joins[:] = False
        if not self.cut or self.widths is None:
            joins[:] = False
        lengths, begin, flat = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [np.zeros(0, np.uint32)]
        for chosen, first in ((joins, False), (~joins, True)):
            if chosen.any():
                size, ids = self._encoded(pieces.filter(pa.array(chosen)), first)
                lengths[chosen], begin[chosen] = size, np.cumsum(size) - size + sum(map(len, flat))
                flat.append(ids)
        return lengths, np.concatenate(flat)[ragged(begin, lengths)]

    def _places(self, pieces: pa.Array, first: bool) -> np.ndarray:
        """Where the ids of each piece are kept; new pieces are encoded first."""
        found = pc.index_in(pieces, value_set=self._known[first])
        new = found.is_null()
        place = found.fill_null(0).to_numpy(zero_copy_only=False)
        place = self._place[first][place] if len(self._place[first]) else place.astype(np.int64)
        if pc.any(new).as_py():
            distinct = pieces.filter(new).dictionary_encode()
            lengths, flat = self._encoded(distinct.dictionary, first)
            fresh = len(self._length) + np.arange(len(lengths))
            self._begin = np.append(self._begin, len(self._ids) + np.cumsum(lengths) - lengths)
            self._length = np.append(self._length, lengths)
            self._ids = np.append(self._ids, flat)
            place[new.to_numpy(zero_copy_only=False)] = fresh[distinct.indices.to_numpy()]
            short = pc.less_equal(pc.binary_length(distinct.dictionary), CACHE_BYTES)
            self._known[first] = pa.concat_arrays([self._known[first], distinct.dictionary.filter(short)])
            self._place[first] = np.append(self._place[first], fresh[short.to_numpy(zero_copy_only=False)])
        return place

    def spans(self, data: np.ndarray, starts: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tokens of each piece, where its ids are) for consecutive spans of pieces; see ``tokens`` for texts."""
        ends = np.append(starts[1:], len(data))
        cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), SPAN_BYTES)), len(starts)))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if len(self._length) > self.cache or len(self._ids) > 8 * self.cache:
                self._clear()
            offsets = np.append(starts[lo:hi], ends[hi - 1]).astype(np.int64)
            offsets, held = offsets - offsets[0], data[starts[lo] : ends[hi - 1]]
            pieces = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(held)])
            opening, place = first[lo:hi], np.zeros(hi - lo, np.int64)
            for kind in (False, True):
                if (chosen := opening == kind).any():
                    place[chosen] = self._places(pieces.filter(pa.array(chosen)), kind)
            lengths = self._length[place]
            yield lengths, self._begin[place]

    def tokens(self, column, with_ids: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Tokens of each row of a text column, and all ids one after another."""
        data, borders = column_bytes(column)
        lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        starts, first = piece_starts(data, borders, self.cut)
        for counts, begins in self.spans(data, starts, first):
            lengths.append(counts)
            if with_ids:
                ids.append(self._ids[ragged(begins, counts)])
        before = np.append(0, np.cumsum(np.concatenate(lengths)))
        return np.diff(before[np.searchsorted(starts, borders)]), np.concatenate(ids) if with_ids else None


@lru_cache(2)
def json_encoder(path: str, cache: int = CACHE_PIECES) -> PieceEncoder:
    """Encoder of a tokenizers file, kept by the Python worker from task to task.

    Texts are cut only for the plain byte-level pre-tokenizer.
    """
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    splitter = spec.get("pre_tokenizer") or {}
    cut = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space") and not spec.get("normalizer")
    cut = cut and all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))

    def encode(pieces: list[str], first: bool) -> list:
        return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    widths = None
    if cut:  # in a byte-level vocabulary each character of a token stands for one byte
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        widths[list(vocabulary.values())] = [len(t) for t in vocabulary]
    return PieceEncoder(encode, bool(cut), widths, cache=cache)
