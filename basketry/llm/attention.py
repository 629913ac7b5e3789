"""A small causal self-attention model in numpy: one head, relative positions, a softmax over classes of ids."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Keys of a window, tokens scored in it, width, classes seen as input and classes predicted.
WINDOW, STEP, WIDTH, INPUTS, OUTPUTS = 32, 16, 16, 1024, 192
_DISTANCE = np.arange(WINDOW - STEP, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_CAUSAL = _DISTANCE >= 0
#: Score of a key that takes no part. Positions whose softmax is taken at a time, so that it stays near the processor.
_NEVER, ROWS = -1e4, 256
_BITS = np.log2(np.e)  # many powers of two take less time than those of e
_APART = np.abs(_DISTANCE)


@dataclass(frozen=True)
class Classes:
    """How ids map to classes: the most frequent ids are their own class, the last class holds the rest.

    Ids of the rest share its probability by their counts plus one.
    """

    inputs: np.ndarray
    outputs: np.ndarray
    log_share: np.ndarray
    begins: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, begins: np.ndarray) -> Classes:
        order = np.argsort(-counts, kind="stable")
        to = lambda n: np.minimum(np.argsort(order, kind="stable"), n - 1).astype(np.int32)
        outputs = to(OUTPUTS)
        rest = outputs == OUTPUTS - 1
        share = np.where(rest, (counts + 1.0) / (counts[rest] + 1.0).sum(), 1.0)
        starts = np.bincount(outputs, weights=share * begins, minlength=OUTPUTS)
        return Classes(to(INPUTS), outputs, np.log(share).astype(np.float32), starts.astype(np.float32))


def start_weights(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    table = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "q": table(INPUTS, WIDTH, scale=0.3), "k": table(INPUTS, WIDTH, scale=0.3), "v": table(INPUTS, WIDTH, scale=0.3), "r": table(INPUTS, WIDTH, scale=0.5),
        "rel": np.zeros(WINDOW, np.float32), "e": table(WIDTH, OUTPUTS, scale=0.3), "b": np.zeros(OUTPUTS, np.float32),
    }


class Windows:
    """Overlapping windows over streams of given lengths that lie one after another.

    Slicing gives the positions of the keys (windows x WINDOW), which of them exist, and which of the last
    STEP positions are tokens to score. Every position is scored in exactly one window. Only the windows
    asked for are laid out, so a long stream takes no more memory than a short one.
    """

    def __init__(self, lengths: np.ndarray):
        each = -(-lengths // STEP)
        begin = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), each)
        self.at = begin[owner] + STEP * (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each))
        self.first, self.end = begin[owner], (begin + lengths)[owner]

    def __len__(self) -> int:
        return len(self.at)

    def __getitem__(self, rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = self.at[rows]
        keys = (at - (WINDOW - STEP))[:, None] + np.arange(WINDOW)
        there = (keys >= self.first[rows][:, None]) & (keys < self.end[rows][:, None])
        return np.where(there, keys, at[:, None]), there, there[:, WINDOW - STEP :]


class _Layers:
    """All weights in one vector, laid out for few and large products: tables of keys and values, of queries and r, e above b."""

    def __init__(self, flat: np.ndarray):
        pairs = INPUTS * 2 * WIDTH
        self.flat = flat
        self.kv, self.qr = flat[:pairs].reshape(INPUTS, -1), flat[pairs : 2 * pairs].reshape(INPUTS, -1)
        self.rel, self.eb = flat[2 * pairs : 2 * pairs + WINDOW], flat[2 * pairs + WINDOW :].reshape(WIDTH + 1, OUTPUTS)
        self.room: dict[str, np.ndarray] = {}

    @staticmethod
    def of(w: dict) -> _Layers:
        return _Layers(np.concatenate([np.hstack([w["k"], w["v"]]).ravel(), np.hstack([w["q"], w["r"]]).ravel(), w["rel"], w["e"].ravel(), w["b"]]))

    def named(self) -> dict:
        return {
            "q": self.qr[:, :WIDTH], "k": self.kv[:, :WIDTH], "v": self.kv[:, WIDTH:], "r": self.qr[:, WIDTH:],
            "rel": self.rel, "e": self.eb[:-1], "b": self.eb[-1],
        }

    def space(self, name: str, *shape: int) -> np.ndarray:
        """An array that the next call with the same name overwrites."""
        if name not in self.room or len(self.room[name]) < shape[0]:
            self.room[name] = np.empty(shape, self.flat.dtype)
        return self.room[name][: shape[0]]

    def prepare(self) -> None:
        """To be called when weights have changed. Exponentials need no shift while the weights bound them, which saves two passes over the scores."""
        kind = self.flat.dtype.type
        self.near = np.where(_CAUSAL, self.rel.take(_APART), kind(0))
        self.outer, self.inner = self.eb * kind(_BITS), np.ascontiguousarray(self.eb[:-1].T)
        self.small = _bound(self) < 70

    def attend(self, x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, ...]:
        """Masked attention of the last STEP positions of each window: scaled queries, keys, values, shares of the keys, their mean value, and h."""
        kv, qr = self.kv.take(x, 0), self.qr.take(x[:, WINDOW - STEP :], 0)
        q, k, v = qr[..., :WIDTH] * self.flat.dtype.type(WIDTH**-0.5), kv[..., :WIDTH], kv[..., WIDTH:]
        a = np.matmul(q, k.transpose(0, 2, 1), out=self.space("a", len(x), STEP, WINDOW))
        a += self.near
        if not self.small:
            a += np.where(_CAUSAL & there[:, None, :], 0, self.flat.dtype.type(_NEVER))
            a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
        a *= _CAUSAL
        some = np.flatnonzero(~(there[:, 0] & there[:, -1]))  # keys that exist follow each other
        if len(some):
            a[some] *= there[some][:, None, :]
        a /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(-1, STEP, 1)
        c = a @ v
        return q, k, v, a, c, np.tanh(c + qr[..., WIDTH:])

    def logits(self, h: np.ndarray) -> np.ndarray:
        """Logits of the classes, for powers of two. Rows of h end in a one, which b goes with."""
        p = np.matmul(h, self.outer, out=self.space("p", len(h), OUTPUTS))
        if not self.small:
            p -= p.max(-1, keepdims=True)
        return p


def _with_ones(h: np.ndarray) -> np.ndarray:
    out = np.ones((len(h), WIDTH + 1), h.dtype)
    out[:, :WIDTH] = h
    return out


def _bound(w: _Layers) -> float:
    """No score of attention and no logit exceeds this: h lies within -1 and 1."""
    logits, near, (k, q) = np.abs(w.eb).sum(0).max(), np.abs(w.rel).max(), (max(t.max(), -t.min()) for t in (w.kv, w.qr))
    scores = k * q * WIDTH**0.5  # a bound that takes little time; if it is too wide, the lengths of the rows
    if scores > 40:
        longest = lambda t: np.sqrt(np.einsum("ij,ij->i", t, t).max())
        scores = longest(w.kv[:, :WIDTH]) * longest(w.qr[:, :WIDTH]) * WIDTH**-0.5
    return float(max(scores + near, logits))


def log_probabilities(w: dict, classes: Classes, ids: np.ndarray, targets: np.ndarray, lengths: np.ndarray, batch: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """Natural logs for every position of the streams: of the target id, and of any id that starts a word."""
    inputs, wanted, laid, layers = classes.inputs[ids], classes.outputs[targets], Windows(lengths), _Layers.of(w)
    out, total, start = (np.empty(len(ids), np.float32) for _ in range(3))
    layers.prepare()
    one, rows, done = np.ones(OUTPUTS, np.float32), np.arange(ROWS) * OUTPUTS, 0
    for lo in range(0, len(laid), batch):
        at, here, use = laid[lo : lo + batch]
        *_, h = layers.attend(inputs.take(at), here)
        h = _with_ones(h[use])  # windows follow each other, and so do the positions scored in them
        for part in range(0, len(h), ROWS):
            p = layers.logits(h[part : part + ROWS])
            some = slice(done + part, done + part + len(p))
            out[some] = p.reshape(-1).take(rows[: len(p)] + wanted[some])
            np.exp2(p, out=p)
            total[some] = p @ one
            start[some] = p @ classes.begins
        done += len(h)
    out *= np.float32(1 / _BITS)
    total = np.log(total)
    out += classes.log_share[targets] - total
    return out, np.log(start + np.float32(1e-30)) - total


def _summed(rows: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Each row of out becomes the sum of the rows that are at its place."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # at most 65,536 places; short integers sort by digits
    at = at.take(order)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    pairs = np.result_type(rows.dtype, np.complex64)  # two columns are added at a time
    out[:] = 0
    out[at[first]] = np.add.reduceat(rows.take(order, 0).view(pairs), first, axis=0).view(rows.dtype)


def _slopes(w: _Layers, x: np.ndarray, there: np.ndarray, use: np.ndarray, y: np.ndarray, out: _Layers) -> float:
    """``gradient`` for weights that are laid out; the slopes go to ``out``."""
    n, kind, whole = len(x), w.flat.dtype.type, bool(use.all())
    q, k, v, a, c, h = w.attend(x, there)
    flat_h, right = (h.reshape(-1, WIDTH), y.ravel()) if whole else (h[use], y[use])
    m, ones, du_flat = len(right), _with_ones(flat_h), np.empty_like(flat_h)
    hit, total, one = np.empty(m, kind), np.empty(m, kind), np.ones(max(OUTPUTS, n), kind)
    spot = np.arange(m) % ROWS * OUTPUTS + right
    out.eb[:] = 0
    for lo in range(0, m, ROWS):
        some = slice(lo, lo + ROWS)
        p = w.logits(ones[some])
        np.exp2(p, out=p)
        flat, at = p.reshape(-1), spot[some]
        hit[some], total[some] = flat.take(at), p @ one[:OUTPUTS]
        flat[at] = hit[some] - total[some]
        share = (1 / (total[some] * m))[:, None]
        np.multiply(p @ w.inner, share, out=du_flat[some])
        out.eb += (ones[some] * share).T @ p
    du_flat *= 1 - flat_h * flat_h
    if whole:
        du = du_flat.reshape(h.shape)
    else:
        du = np.zeros_like(h)
        du[use] = du_flat
    ds = np.matmul(du, v.transpose(0, 2, 1), out=w.space("ds", n, STEP, WINDOW))
    ds -= ((du * c).reshape(-1, WIDTH) @ one[:WIDTH]).reshape(n, STEP, 1)
    ds *= a
    out.rel[:] = np.bincount(_APART[_CAUSAL], weights=(one[:n] @ ds.reshape(n, -1)).reshape(STEP, WINDOW)[_CAUSAL], minlength=WINDOW)
    rows = w.space("rows", n * (WINDOW + STEP), 2 * WIDTH)  # of keys and values, then of queries and r
    keys, queries = rows[: n * WINDOW].reshape(n, WINDOW, -1), rows[n * WINDOW :].reshape(n, STEP, -1)
    np.matmul(ds.transpose(0, 2, 1), q, out=keys[..., :WIDTH])
    np.matmul(a.transpose(0, 2, 1), du, out=keys[..., WIDTH:])
    np.multiply(ds @ k, kind(WIDTH**-0.5), out=queries[..., :WIDTH])
    queries[..., WIDTH:] = du
    _summed(rows, np.concatenate([x.ravel(), x[:, WINDOW - STEP :].ravel() + INPUTS]), out.flat[: 2 * out.kv.size].reshape(2 * INPUTS, -1))
    return -float(np.log(hit / total + kind(1e-30)).mean())


def gradient(w: dict, x: np.ndarray, there: np.ndarray, use: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
    """Gradient of the mean negative log-likelihood of the classes y, and that mean."""
    layers = _Layers.of(w)
    layers.prepare()
    out = _Layers(np.empty_like(layers.flat))
    loss = _slopes(layers, x, there, use, y, out)
    return out.named(), loss


def descend(w: dict, batches: Iterable[tuple[np.ndarray, ...]], rate: float) -> tuple[dict, float]:
    """Weights after one Adam step on each batch (input classes, which keys exist, which positions count, output classes), and the mean loss of the last tenth."""
    layers, losses = _Layers.of(w), []
    out = _Layers(np.empty_like(layers.flat))
    slope, mean, square = out.flat, np.zeros_like(layers.flat), np.zeros_like(layers.flat)
    for step, drawn in enumerate(batches, 1):
        layers.prepare()
        losses.append(_slopes(layers, *drawn, out))
        mean *= 0.9  # ten times the mean, and a hundred times the mean square
        mean += slope
        slope *= slope
        square *= 0.99
        square += slope
        scale = 0.1 * (1 - 0.99**step) ** -0.5
        np.sqrt(square, out=slope)
        slope += 1e-8 / scale
        np.divide(mean, slope, out=slope)
        slope *= 0.1 * rate / (1 - 0.9**step) / scale
        layers.flat -= slope
    return {n: v.copy() for n, v in layers.named().items()}, float(np.mean(losses[-max(1, len(losses) // 10) :])) if losses else 0.0


def train(w: dict, x: np.ndarray, there: np.ndarray, use: np.ndarray, y: np.ndarray, steps: int, rate: float, seed: int, batch: int) -> tuple[dict, float]:
    """``descend`` for some steps, each on a batch drawn from the windows given."""
    if not len(x):
        return w, 0.0
    rng = np.random.default_rng(seed)
    draws = (rng.integers(0, len(x), batch) for _ in range(steps))
    return descend(w, ((x[rows], there[rows], use[rows], y[rows]) for rows in draws), rate)
