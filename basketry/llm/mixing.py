"""Mix documents to target weights by iterative proportional fitting, in DataFrame operations only.

Tokens are summed per cell (source, language, topic). Cell weights are raked to the target shares of
one dimension after the other until all fit. Documents are then drawn with a probability that follows
their cell's weight per token, and carry what is left of it as a weight for training.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.llm.scratch import written

log = logging.getLogger(__name__)

#: Rounds of raking in one job, the relative error of a share at which it ends, and the least fall of that error that is progress.
ROUNDS, CLOSE, PROGRESS = 6, 1e-4, 0.98
#: Share of all tokens that is drawn, and the power that tempers the shares of a dimension.
KEEP, TEMPER = 0.95, 0.8
SEED = 42
SPACES, BLANK = r"[\x20\x09-\x0D]+", tuple(" \t\n\v\f\r")


def form_topic(text: Column) -> Column:
    """A topic from the form of a text, for tables without topics: empty, table, figures, list, speech or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda chars: F.regexp_count(text, F.lit(chars)) / size
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(F.length(F.trim(text)) == 0, "empty")
        .when(share(r"[|\t{}<>=#$%&*]") > 0.03, "table")
        .when(share("[0-9]") > 0.02, "figures")
        .when(size / lines < 60, "list")
        .when(share("[!?\"]") > 0.01, "speech")
        .otherwise("prose")
    )


def token_estimate(text: Column) -> Column:
    """Words and one end. Runs of white space are counted, which is cheaper than counting words."""
    runs = F.regexp_count(text, F.lit(SPACES))
    edges = sum(edge(text, F.lit(1)).isin(*BLANK).cast("int") for edge in (F.left, F.right))
    return (F.when(F.length(text) == 0, 0).otherwise(runs + 1 - edges) + 1).cast("long")


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """(value, share): the table's own shares of tokens, flattened by a power below 1."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("p"))
    total = sums.agg(F.sum("p").alias("all"))
    return sums.join(F.broadcast(total)).select(F.col(dimension).alias("value"), (F.col("p") / F.col("all")).alias("share"))  # one row


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, close: float = CLOSE) -> DataFrame:
    """cells with ``w``, their tokens, scaled so that every dimension has its target shares, and ``error``.

    ``error`` says by how much of itself the largest miss among the sums of a cell's categories had to be
    mended in the last round. Raking goes on until that is below ``close`` everywhere, or stops falling:
    targets may contradict each other where categories occur together only. Then the last dimension has its
    shares, and the errors show where the others miss theirs.

    ``targets``: (value, share) per dimension; shares are taken among the values that occur, a value
    without a share gets weight 0. Weights sum to the tokens of all cells. A few rounds make a job, whose
    result is written to the shared folder; all windows are over cells, whose number grows with the
    categories and not with the documents.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells
    for dimension, target in targets.items():
        there = target.where("share > 0").join(cells.where("tokens > 0").select(F.col(dimension).alias("value")).distinct(), "value", "left_semi")
        share = there.agg(F.sum("share")).first()[0] or 1.0
        goals = there.select(F.col("value").alias(dimension), (F.col("share") * (total / share)).alias(f"goal_{dimension}"))
        now = now.join(goals, dimension, "left")
    now = written(now.withColumn("w", F.col("tokens").cast("double")), "raked")
    before = float("inf")
    while True:
        for number in range(rounds):
            for dimension in targets:
                s = F.sum("w").over(Window.partitionBy(dimension))
                now = now.withColumn("f", F.when(s > 0, F.coalesce(f"goal_{dimension}", F.lit(0.0)) / s).otherwise(0.0)).withColumn("w", F.col("w") * F.col("f"))
                if number == rounds - 1:  # how far this share was off before its last scaling
                    now = now.withColumn(f"off_{dimension}", F.when(F.col("w") > 0, F.abs(F.col("f") - 1)).otherwise(0.0))
        off = F.greatest(*(F.col(f"off_{d}") for d in targets), F.lit(0.0))
        now = written(now.withColumn("off", off).drop("f", *(f"off_{d}" for d in targets)), "raked")
        worst = now.agg(F.max("off")).first()[0] or 0.0
        if worst < close or worst > before * PROGRESS:
            break
        now, before = now.drop("off"), worst
    if worst >= close:
        log.warning("raking ends with an error of %.2g: the target shares cannot all be met", worst)
    return now.withColumnRenamed("off", "error").drop(*(f"goal_{d}" for d in targets))


def calibrated(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """cells (tokens, w) with ``probability`` and ``weight``.

    A cell's documents are drawn with probability min(1, c w / tokens), c such that ``keep`` of all tokens
    are expected; weight is max(1, c w / tokens), so that probability x weight follows w exactly.
    """
    rated = cells.withColumn("r", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0))
    total = rated.agg(F.sum(F.when(F.col("w") > 0, F.col("tokens")))).first()[0] or 0
    goal, c, before = keep * total, 0.0, -1
    while total:  # cells at probability 1 only become more; each step reads the cell table once
        at_one = F.col("r") * F.lit(c) >= 1
        n, full, rest = rated.agg(F.count(F.when(at_one, 1)), F.sum(F.when(at_one, F.col("tokens"))), F.sum(F.when(~at_one, F.col("w")))).first()
        if n == before or not rest:
            break
        c, before = max(c, (goal - (full or 0)) / rest), n
    scaled = F.col("r") * F.lit(float(c))
    return rated.select("*", F.least(F.lit(1.0), scaled).alias("probability"), F.greatest(F.lit(1.0), scaled).alias("weight")).drop("r")


def chance(ident: Column, text: Column, seed: int = SEED) -> Column:
    """A fixed number in [0, 1) for each id; rows without id draw by their text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(ident.cast("string"), text)), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    keep: float = KEEP,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
) -> DataFrame:
    """docs with mix_topic, mix_tokens, mix_probability, mix_weight, mix_error and mix_drawn; no row is dropped here.

    ``mix_error`` is the relative error that raking left in the shares of the row's source, language or
    topic: about 0 unless the targets contradict each other.

    ``targets`` has (value, share) tables for some of source, lang and topic; by default each dimension
    aims at its own shares, tempered. Null text is empty text (its end is its one token); null categories
    form the category ''. Repeated rows have one fate, as the draw depends on the id alone. An empty
    table gives an empty result; a very long text counts whole. Existing columns of the new names are replaced.
    """
    # Own columns are set apart by position, so that no name of the caller's can clash.
    names = [f"k{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names))
    text = F.coalesce(F.col(of[text_col]), F.lit(""))
    given = [] if topic is None else [topic.alias("topic")]
    held = docs.select("*", *given).toDF(*names, *(["topic0"] if given else []))
    topic = F.coalesce(F.col("topic0"), F.lit("")) if given else form_topic(text)
    return _mixed(held, docs.columns, of, topic, text, targets, keep, id_col, source_col, lang_col)


def _mixed(held, columns, of, topic, text, targets, keep, id_col, source_col, lang_col) -> DataFrame:
    keys = ["source", "lang", "topic"]
    measured = held.select(
        *of.values(), F.coalesce(F.col(of[source_col]), F.lit("")).alias("source"), F.coalesce(F.col(of[lang_col]), F.lit("")).alias("lang"), topic.alias("topic"),
        token_estimate(text).alias("tokens"), chance(F.col(of[id_col]), text).alias("u"),
    )
    # The cell sums combine before the shuffle: a source of a third of all rows is a few rows there.
    cells = written(measured.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = calibrated(rake(cells, targets or {k: tempered(cells, k) for k in keys}), keep)
    fitted = written(fitted.select(*keys, "probability", "weight", "error"), "mixture")
    joined = measured.join(fitted, keys, "left")
    made = {"mix_topic": F.col("topic"), "mix_tokens": F.col("tokens"), "mix_probability": F.col("probability"), "mix_weight": F.col("weight"), "mix_error": F.col("error"), "mix_drawn": F.col("u") < F.col("probability")}
    return joined.select(*(F.col(of[c]).alias(c) for c in columns if c not in made), *(v.alias(k) for k, v in made.items()))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "source", "lang", *(F.col(f"mix_{c}").alias(c) for c in ("topic", "tokens", "probability", "weight", "drawn")))
