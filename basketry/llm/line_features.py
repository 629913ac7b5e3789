"""Numbers that describe each line of a text, computed for a whole Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of each kind.
_KINDS = np.zeros(256, np.uint8)
_KINDS[48:58] = 1  # digits
_KINDS[65:91] = 2  # capitals
_KINDS[[*b"#$%&*|<>{}[]=@^~_\\/+"]] = 3  # symbols
_KINDS[[*b"!?"]] = 4
_KINDS[[*b".,;:'\"()-"]] = 5  # punctuation of prose
_KINDS[[9, 11, 12, 13, 32]] = 6  # white space

NAMES = (
    "length", "digits", "capitals", "symbols", "cries", "punctuation", "white", "words", "word_length", "repeats", "distinct", "two_apart", "closed",
    "opened", "repeated_line", "lone",
)


def line_features(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x NAMES), bytes of each line, and lines of each text.

    Lines end at line feeds; an empty text is one empty line. Takes about 20 bytes of memory per byte
    of the batch.
    """
    n_texts, n = len(borders) - 1, len(data)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([borders[:-1], breaks + 1]), kind="stable")
    owner = np.searchsorted(borders[1:], breaks, side="right")
    lines = np.bincount(owner, minlength=n_texts) + 1
    # A line feed at a text's end opens an empty line there, at the next text's start: sorting keeps both.
    ends = np.empty_like(starts)
    last = np.cumsum(lines) - 1
    ends[:-1] = starts[1:] - 1
    ends[last] = borders[1:]
    size = ends - starts
    safe = np.maximum(size, 1)
    kind = _KINDS[data]
    share = []
    for k in range(1, 7):
        total = np.zeros(n + 1, np.int32)
        np.cumsum(kind == k, out=total[1:])
        share.append((total[ends] - total[starts]) / safe)
    # Words: runs between white space and line feeds.
    blank = (kind == 6) | (data == 10)
    edge = np.empty(n, bool)
    if n:
        edge[0] = True
        edge[1:] = blank[:-1]
        edge[borders[:-1][borders[:-1] < n]] = True
    begin = np.flatnonzero(edge & ~blank)
    stop = blank.copy()
    stop_at = np.append(np.flatnonzero(stop), n)
    finish = np.minimum(stop_at[np.searchsorted(stop_at, begin)], borders[np.searchsorted(borders, begin, side="right")] if n else n)
    line_of = np.searchsorted(starts, begin, side="right") - 1
    hashes = RunHashes(data)
    code = hashes(begin, finish)
    words = np.bincount(line_of, minlength=len(starts))
    some = np.maximum(words, 1)
    again = lambda gap: np.bincount(line_of[gap:][(code[gap:] == code[:-gap]) & (line_of[gap:] == line_of[:-gap])], minlength=len(starts)) / some
    order = np.lexsort((code, line_of))
    fresh = np.append(True, (code[order][1:] != code[order][:-1]) | (line_of[order][1:] != line_of[order][:-1]))[: len(order)]
    distinct = np.bincount(line_of[order][fresh], minlength=len(starts)) / some
    letters = np.bincount(line_of, weights=finish - begin, minlength=len(starts)) / some
    first, final = np.zeros(len(starts)), np.zeros(len(starts))
    full = size > 0
    first[full] = kind[starts[full]] == 2
    final[full] = np.isin(data[ends[full] - 1], np.frombuffer(b".!?", np.uint8))
    line_code = hashes(starts, ends)
    text_of = np.repeat(np.arange(n_texts), lines)
    by = np.lexsort((line_code, text_of))
    same = np.zeros(len(starts), bool)
    if len(starts) > 1:
        twin = (line_code[by][1:] == line_code[by][:-1]) & (text_of[by][1:] == text_of[by][:-1])
        same[by[1:][twin]] = True
        same[by[:-1][twin]] = True
    x = np.column_stack([np.log1p(size), *share, np.log1p(words), np.log1p(letters), again(1), distinct, again(2), final, first, same & full, np.repeat(lines == 1, lines)])
    return x.astype(np.float32), size, lines


_BASE, _MASK, _PAGE = 0x9E3779B97F4A7C15, (1 << 64) - 1, 1 << 16


class RunHashes:
    """Polynomial hashes (mod 2^64) of runs of bytes, equal for equal runs wherever they stand."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.full(_PAGE, np.uint64(_BASE)))  # powers 1, 2, ... of the base
            self.down = np.cumprod(np.full(_PAGE, np.uint64(pow(_BASE, -1, 1 << 64))))
            self.total = np.zeros(len(data) + 1, np.uint64)
            for at in range(0, len(data), _PAGE):  # powers start anew on each page
                part = data[at : at + _PAGE]
                self.total[at + 1 : at + 1 + len(part)] = (part.astype(np.uint64) + np.uint64(1)) * self.up[: len(part)]
            np.cumsum(self.total, out=self.total)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = self.total
        with np.errstate(over="ignore"):
            out = (total[end] - total[begin]) * self.down[begin & (_PAGE - 1)]
            for i in np.flatnonzero((begin >> 16) != (np.maximum(end, begin + 1) - 1) >> 16).tolist():  # runs over pages: a few on each
                b, e, value = int(begin[i]), int(end[i]), 0
                at = b
                while at < e:
                    upto = min(e, (at // _PAGE + 1) * _PAGE)
                    part = (int(total[upto]) - int(total[at])) * int(self.down[at % _PAGE])
                    value = (value + part * pow(_BASE, at - b, 1 << 64)) & _MASK
                    at = upto
                out[i] = value
            return out ^ ((end - begin).astype(np.uint64) << np.uint64(40))


def batch_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    from basketry.llm.pieces import column_bytes

    return line_features(*column_bytes(column))
