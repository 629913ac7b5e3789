"""Histogram, mean and exact median of an amount column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.columns import require_columns
from basketry.functions.money import exact_avg

#: Ranks of the quantile sketch are right to one part in this many; ranges that the rows around the middle are cut into.
SKETCH_ACCURACY, RANGES = 100_000, 1_000


def _finite(df: DataFrame, column: str) -> DataFrame:
    """The amounts as ``x``. Null, NaN and infinite amounts have no place on an axis: they take part in none of these results."""
    x = F.col("x")
    return df.select(F.col(column).cast("double").alias("x")).filter(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def histogram(df: DataFrame, column: str = "total_amount", bins: int = 15) -> DataFrame:
    """Equal-width bins of the finite amounts, the last one closed, empty bins included.

    A column with a single value is shown in a range of width one around it.
    """
    require_columns(df, column)
    values = _finite(df, column)
    low, high = F.min("x"), F.max("x")
    margin = F.when(low == high, 0.5).otherwise(0.0)
    bounds = values.agg(
        (low - margin).alias("low"), ((high - low + margin * 2) / F.lit(bins)).alias("width")
    ).filter(F.col("low").isNotNull())
    edges = bounds.select(F.struct("low", "width")).scalar()
    position = F.floor((F.col("x") - edges["low"]) / edges["width"])
    counted = values.groupBy(F.least(position, F.lit(bins - 1).cast("bigint")).alias("bin")).agg(
        F.count("*").alias("n")
    )
    every_bin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")))
    # One row per bin on either side.
    return (
        bounds.select(every_bin.alias("bin"), "low", "width")
        .join(F.broadcast(counted), "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def median_frame(df: DataFrame, column: str = "total_amount") -> DataFrame:
    """One row ``median``: the exact median of the finite amounts, null when there are none.

    The built-in exact percentile gathers every distinct value in one task. Here the middle ranks are
    closed in by ranges. A quantile sketch gives two borders around them, with 4 / SKETCH_ACCURACY of the
    rows between; the sketch of these rows cuts them into RANGES ranges of about equal counts. The rows
    below are counted exactly, so the middle ranks are known to lie in a few of the ranges. Only the values
    of these, about two in 10^7 of all, are put in order, in one array; equal values count as one.
    """
    require_columns(df, column)
    values, x, n = _finite(df, column), F.col("x"), F.col("n")
    # As SQL text: a column object for every share would take seconds to build.
    sketch = lambda what, shares: F.expr(f"percentile_approx({what}, array({', '.join(f'{s!r}D' for s in shares)}), {SKETCH_ACCURACY})")
    around = values.agg(F.count("*").alias("all"), sketch("x", [0.5 - 2 / SKETCH_ACCURACY, 0.5 + 2 / SKETCH_ACCURACY]).alias("border"))
    border = around.select("border").scalar()
    ranged = values.filter(x <= border[1]).select(F.when(x >= border[0], x).alias("inside")).agg(
        F.count_if(F.col("inside").isNull()).alias("below"), F.count("inside").alias("held"), sketch("inside", [i / RANGES for i in range(RANGES + 1)]).alias("at")
    )
    ranged = ranged.withColumn("all", around.select("all").scalar())
    # The middle ranks' place among the ranges; the sketch's own error is a hundredth of a range, so two on either side are ample.
    place = F.try_divide(F.col("all") / 2 - F.col("below"), F.col("held")) * RANGES
    low = F.get("at", F.greatest(F.floor(place) - 2, F.lit(0)).cast("int"))
    high = F.get("at", F.least(F.ceil(place) + 2, F.lit(RANGES)).cast("int"))
    lowest, highest = (ranged.select(border).scalar() for border in (low, high))
    counted = values.filter(x <= highest).groupBy(F.when(x >= lowest, x).alias("x")).agg(F.count("*").alias("n"))
    ordered = counted.agg(
        F.coalesce(F.sum(F.when(x.isNull(), n)), F.lit(0)).alias("before"), F.array_sort(F.collect_list(F.when(x.isNotNull(), F.struct("x", "n")))).alias("values")
    ).withColumn("all", around.select("all").scalar())

    def step(found: Column, value: Column) -> Column:
        """Adds a value's rows; a and b are the first values whose rank reaches the lower and the upper middle."""
        upto = found["upto"] + value["n"]
        reached = lambda name, rank: F.when(found[name].isNotNull() | (upto * 2 < rank), found[name]).otherwise(value["x"]).alias(name)
        return F.struct(upto.alias("upto"), reached("a", F.col("all")), reached("b", F.col("all") + 1))

    nothing = F.lit(None).cast("double")
    start = F.struct(F.col("before").alias("upto"), nothing.alias("a"), nothing.alias("b"))
    middle = ordered.select(F.aggregate("values", start, step).alias("m")).select("m.a", "m.b")
    both = (F.col("a") + F.col("b")) / 2
    halves = F.col("a") / 2 + F.col("b") / 2  # where the sum leaves the range of doubles
    return middle.select(F.when(F.col("a") == F.col("b"), F.col("a")).when(F.abs(both) < float("inf"), both).otherwise(halves).alias("median"))


def exact_median(df: DataFrame, column: str = "total_amount") -> float | None:
    """The value of ``median_frame`` (runs its passes)."""
    return median_frame(df, column).first()["median"]


def amount_center(df: DataFrame, column: str = "total_amount") -> DataFrame:
    """Mean and exact median of the finite amounts."""
    mean = _finite(df, column).agg(exact_avg("x").alias("mean_amount"))
    return mean.withColumn("median_amount", median_frame(df, column).scalar())
