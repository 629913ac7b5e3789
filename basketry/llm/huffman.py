"""Canonical length-limited Huffman codes over integer ids, in numpy."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Best code lengths of at most ``most`` bits for counts > 0 (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << most:
        raise ValueError(f"{n} symbols do not fit in codes of {most} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(most):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank][: len(merged) // 2 * 2]
        packages = merged.reshape(-1, 2).sum(1)
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:wanted].sum())
        lengths[:leaves] += 1
        wanted = 2 * (wanted - leaves)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes from (id, length): shorter first, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, most: int):
        order = np.lexsort((ids, lengths))
        self.most, self.ids, length = most, ids[order].astype(np.uint32), lengths[order].astype(np.int64)
        wide = np.int64(1) << (most - length)  # codes as their share of the table of 2^most entries
        first = np.cumsum(wide) - wide
        top = int(self.ids.max()) + 1 if len(ids) else 0
        self.code, self.length = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.code[self.ids] = (first >> (most - length)).astype(np.uint64)
        self.length[self.ids] = length
        self.symbol_of = np.zeros(1 << most, np.uint32)
        self.length_of = np.ones(1 << most, np.uint8)
        used = int(wide.sum()) if len(ids) else 0
        self.symbol_of[:used] = np.repeat(self.ids, wide)
        self.length_of[:used] = np.repeat(length, wide)

    def encode(self, ids: np.ndarray, step: int) -> tuple[bytes, np.ndarray]:
        """Bits of the ids, and the bit offset of every ``step``-th id."""
        length = self.length[ids]
        ends = np.cumsum(length)
        at = ends - length
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros((total + 31) // 32 + 2, np.uint64)
        if len(ids):
            placed = self.code[ids] << (64 - (at & 31) - length).astype(np.uint64)
            word = at >> 5
            new = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            words[word[new]] += np.add.reduceat(placed >> np.uint64(32), new)
            words[word[new] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), new)
        return words.astype(">u4").tobytes(), at[::step].astype(np.uint64)

    def decode(self, bits: bytes, marks: np.ndarray, n: int, step: int) -> np.ndarray:
        """The n ids; all stretches between marks advance together, one table look-up a step."""
        b = np.frombuffer(bits, np.uint8).astype(np.uint32)
        window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        out = np.zeros((len(marks), step), np.uint32)
        at, shift = marks.astype(np.int64), np.uint32(32 - self.most)
        last = n - (len(marks) - 1) * step  # ids of the last stretch
        for k in range(step if len(marks) > 1 else last):
            if k == last:
                at = at[:-1]
            key = (window[at >> 3] << (at & 7).astype(np.uint32)) >> shift
            out[: len(at), k] = self.symbol_of[key]
            at = at + self.length_of[key]
        return out.reshape(-1)[:n]
