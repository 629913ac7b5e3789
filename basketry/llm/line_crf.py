"""Document quality from a linear-chain conditional random field over lines.

Every line is good (1) or bad (0). A line's features are its own, its two neighbours' and the mean of
its document; a transition weight joins the labels of neighbouring lines. A document's score is the
mean of the forward-backward marginals of its lines, weighted by line length.

Labels exist for documents only, so in training all lines of a document carry its label. The model is
fitted on the driver from a bounded sample of labelled documents (``SAMPLE`` documents of at most
``SAMPLE_LINES`` lines, those of smallest hash); every document is scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.line_features import batch_lines
from basketry.llm.pieces import balanced

SAMPLE, SAMPLE_LINES, STEPS, RIDGE = 6_000, 300, 160, 1e-3


def with_neighbours(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own features, those of the previous and next line (zeros beyond the text), text means, and a constant."""
    n = len(x)
    last = np.cumsum(lines) - 1
    first = last - lines + 1
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    mean = np.add.reduceat(x, first, axis=0) / lines[:, None] if n else np.zeros((0, x.shape[1]))
    return np.hstack([x, before, after, np.repeat(mean, lines, axis=0), np.ones((n, 1))]).astype(np.float32)


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(emit: np.ndarray, lines: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(line good), expected transitions (2 x 2), and the sum of log partition functions.

    ``emit``: score of good against bad, per line. All texts advance together, longest first.
    """
    order = np.argsort(-lines, kind="stable")
    length = lines[order]
    first = (np.cumsum(lines) - lines)[order]
    forward, backward = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length.max(initial=0)))]  # texts with more than t lines
    for t, m in enumerate(active):
        at = first[:m] + t
        if t:
            past = forward[at - 1]
            forward[at] = _log_sum(past[:, :1] + trans[0], past[:, 1:] + trans[1])
        forward[at, 1] += emit[at]
    for t in range(len(active) - 2, -1, -1):
        m = active[t + 1]
        at = first[:m] + t
        ahead = backward[at + 1].copy()
        ahead[:, 1] += emit[at + 1]
        backward[at] = _log_sum(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    ends = np.cumsum(lines) - 1
    log_z = _log_sum(forward[ends, 0], forward[ends, 1])
    good = 1 / (1 + np.exp(-np.clip(forward[:, 1] + backward[:, 1] - forward[:, 0] - backward[:, 0], -500, 500)))
    inner = np.ones(len(emit), bool)
    inner[ends] = False
    at = np.flatnonzero(inner)
    pair = forward[at][:, :, None] + trans[None] + (backward[at + 1] + np.column_stack([np.zeros(len(at)), emit[at + 1]]))[:, None, :]
    pair = np.exp(pair - np.repeat(log_z, lines)[at][:, None, None])
    return good, pair.sum(0), float(log_z.sum())


@dataclass(frozen=True)
class LineModel:
    """Weights; with no features (one label or none to learn from) the prior decides."""

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    trans: np.ndarray | None = None

    def inputs(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return with_neighbours(np.clip((x - self.centre) / self.scale, -6, 6), lines)

    def scores(self, x: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Quality of each text, 0 to 1."""
        if self.weights is None or not len(lines):
            return np.full(len(lines), self.prior)
        good, _, _ = marginals((self.inputs(x, lines) @ self.weights).astype(np.float64), lines, self.trans)
        weight = size + 1.0
        first = np.cumsum(lines) - lines
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0, 1)


def fit(x: np.ndarray, lines: np.ndarray, label: np.ndarray, steps: int = STEPS) -> LineModel:
    """Penalised maximum likelihood by Adam; a text's likelihood counts by the inverse of its lines' number."""
    prior = float((label.sum() + 1) / (len(label) + 2))
    if not 0 < label.sum() < len(label):
        return LineModel(prior)
    model = LineModel(prior, x.mean(0), x.std(0) + 1e-3)
    inputs = model.inputs(x, lines)
    of_line = np.repeat(label, lines).astype(np.float64)
    same = np.repeat(label, np.maximum(lines - 1, 0))
    counts = np.array([[np.sum(same == 0), 0], [0, np.sum(same == 1)]], np.float64)
    theta = np.zeros(inputs.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    n = len(of_line)
    for step in range(1, steps + 1):
        weights, trans = theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2)
        good, pairs, _ = marginals((inputs @ weights).astype(np.float64), lines, trans)
        slope = np.append(inputs.T @ (of_line - good).astype(np.float32) / n, ((counts - pairs) / n).ravel()) - RIDGE * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.98 * square + 0.02 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.98**step)) + 1e-8)
    return LineModel(prior, model.centre, model.scale, theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2))


def remainder(id_col, by: int):
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> LineModel:
    """Model from the labelled rows; labels that are not 0 or 1, and rows without id, are left out.

    Of several labels for an id the smallest counts, of several texts all do.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    chosen = known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in balanced(batches, 1):
            x, _, lines = batch_lines(batch.column(1))
            first = np.cumsum(lines) - lines
            rows = [x[a : a + n].astype("<f4").tobytes() for a, n in zip(first, lines)]
            few = pa.array(lines <= SAMPLE_LINES)
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lines), pa.array(rows, pa.binary())], ["id", "label", "lines", "x"])
            yield made.filter(few)

    # At most ``sample`` rows are broadcast.
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "text", "label")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = found.mapInArrow(features, f"id {kind}, label int, lines long, x binary").orderBy(F.xxhash64("id"), F.xxhash64("x")).limit(sample).collect()
    if not rows:
        return LineModel(0.5)
    lines, label = np.array([r["lines"] for r in rows]), np.array([r["label"] for r in rows])
    x = np.frombuffer(b"".join(r["x"] for r in rows), "<f4").reshape(int(lines.sum()), -1)
    return fit(x, lines, label)


def with_quality(docs: DataFrame, model: LineModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and score for every row; a null text counts as an empty one."""
    names = [f"c{i}" for i in range(len(keep))]
    chosen = docs.select(F.col(f"`{text_col}`").alias("t"), *(F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in chosen.schema[1:])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in balanced(batches, 0):
            score = model.scores(*batch_lines(batch.column(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score, pa.float64())], [*names, "score"])

    return chosen.mapInArrow(work, f"{kinds}score double").toDF(*keep, "score")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held: int = 1) -> DataFrame:
    """id, held_out, score (0 to 1) and predicted (1 if score >= 0.5) for every row of docs.

    Labels of rows whose crc32(id as text) mod ``folds`` is ``held`` are never read by the fit. A row
    without id is scored and not held out. Without any label every score is 0.5; with labels of one
    kind every score is that kind's smoothed share. Repeated rows stay repeated.
    """
    model = fit_quality(docs, labels.where(remainder(id_col, folds) != held), id_col, text_col)
    scored = with_quality(docs, model, [id_col], text_col)
    return scored.select(id_col, F.coalesce(remainder(id_col, folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
