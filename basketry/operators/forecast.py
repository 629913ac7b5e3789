"""Linear sales forecast on calendar features, and its comparison with history.

The model predicts the amount of one order from (day, weekday, month). Reports
that set its mean beside *daily* sales compare different units; fit on
``grain="day"`` features to forecast daily totals instead.

A model is a DataFrame of one row: the rows it was fitted on, a coefficient per
feature and the intercept. It is fitted inside the plan, so nothing runs before
a result that uses it does.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.constants import (
    ARROW_DOWN,
    ARROW_UP,
    BASELINE_NAME,
    FEATURES,
    L1_RATIO,
    MAX_ITER,
    MIN_DELIVERED,
    MIN_TRAINING_ROWS,
    MODEL_NAME,
    PREDICTION_PREFIX,
    REG_PARAM,
    TREND_DOWN,
    TREND_UP,
)
from basketry.functions.calendar import AsOf, as_of_column, to_day, weekday_name
from basketry.functions.columns import require_columns
from basketry.functions.money import exact_avg, exact_sum
from basketry.functions.predicates import delivered_contains


def training_rows(orders: DataFrame, delivered: Column | None = None, min_rows: int = MIN_DELIVERED) -> DataFrame:
    """Delivered orders, or all orders when fewer than ``min_rows`` are delivered.

    One lazy plan of two parts. The filter of the delivered orders reaches their scan. The other orders
    are joined with a gate, which is empty if there are enough delivered ones; adaptive execution then
    drops that part before it reads anything. Counting for the gate stops at ``min_rows`` in every task.
    """
    wanted = delivered_contains() if delivered is None else delivered
    done = orders.filter(wanted)
    gate = done.select(F.lit(1).alias("one")).limit(min_rows).agg((F.count("one") >= min_rows).alias("enough")).filter(~F.col("enough"))
    is_done = F.coalesce(wanted, F.lit(False))
    return done.union(orders.filter(~is_done).join(F.broadcast(gate), is_done == F.col("enough"), "left_semi"))  # one row, or none


def calendar_columns(day: Column) -> list[Column]:
    return [
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("weekday"),
        F.month(day).alias("month"),
    ]


def training_features(rows: DataFrame, grain: str = "order") -> DataFrame:
    """Amount and calendar features, one row per order or per day."""
    require_columns(rows, "date", "total_amount")
    if grain == "order":
        return rows.select("total_amount", *calendar_columns(to_day("date")))
    if grain == "day":
        days = rows.groupBy(to_day("date").alias("date")).agg(exact_sum("total_amount").alias("total_amount"))
        return days.select("total_amount", *calendar_columns(F.col("date")))
    raise ValueError(f"grain must be 'order' or 'day', not {grain!r}")


def feature_cells(features: DataFrame) -> DataFrame:
    """Rows, amounts and squared amounts per combination of features: at most 31 x 7 x 12 rows, whatever the input.

    Rows without a feature or a finite amount take no part.
    """
    amount = F.col("total_amount").cast("double")
    finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    return features.dropna(subset=[*FEATURES, "total_amount"]).filter(finite).groupBy(*FEATURES).agg(
        F.count("*").alias("n"), exact_sum("total_amount").alias("s"), exact_sum("total_amount * total_amount").alias("q")
    )


def gram(cells: DataFrame) -> DataFrame:
    """One row: n, y, yy, and per feature or pair of features x_f, xy_f, xx_f_g.

    These sums are all that a linear fit needs. They are exact, so they do not depend on the order of
    rows or on the partitioning, and sums of parts of the data add up to those of the whole.
    """
    sums = [F.sum("n").alias("n"), exact_sum("s").alias("y"), exact_sum("q").alias("yy")]
    for f in FEATURES:
        sums += [F.sum(F.col("n") * F.col(f)).alias(f"x_{f}"), exact_sum(f"s * {f}").alias(f"xy_{f}")]
    for f, g in combinations_with_replacement(FEATURES, 2):
        sums.append(F.sum(F.col("n") * F.col(f) * F.col(g)).alias(f"xx_{f}_{g}"))
    return cells.agg(*sums)


def _pair(f: str, g: str) -> str:
    return f"{f}_{g}" if FEATURES.index(f) <= FEATURES.index(g) else f"{g}_{f}"


def _over(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where whole is 0: a constant column takes no part in a fit."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def fit_model(features: DataFrame, max_iter: int = MAX_ITER, reg: float = REG_PARAM, l1_ratio: float = L1_RATIO) -> DataFrame:
    """Elastic-net fit of the amount on the calendar features: one row n_rows, a coefficient per feature, intercept.

    Minimises half the mean squared error plus reg * (l1_ratio * |b| + (1 - l1_ratio) / 2 * b * b / s) over the
    coefficients b of features scaled to variance 1, s the amounts' standard deviation. ``max_iter``
    rounds of coordinate descent run on the Gram matrix, as a fold inside the plan. Fewer than
    MIN_TRAINING_ROWS usable rows are an error when the model is used.
    """
    whole = F.col("n").cast("decimal(19,0)")
    n = F.col("n").cast("double")
    enough = F.when(F.col("n") >= MIN_TRAINING_ROWS, F.col("n")).otherwise(
        F.raise_error(F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(f" usable rows; at least {MIN_TRAINING_ROWS} needed to fit")))
    )
    sums = gram(feature_cells(features)).withColumn("n", enough.cast("bigint"))
    integer = lambda c: F.col(c).cast("decimal(19,0)")
    means = {f"m_{f}": F.col(f"x_{f}") / n for f in FEATURES} | {"m": F.col("y") / n}
    # The products of whole numbers are exact: a feature without variance has exactly none.
    spread = {
        f"c_{_pair(f, g)}": (whole * integer(f"xx_{_pair(f, g)}") - integer(f"x_{f}") * integer(f"x_{g}")).cast("double") / n / n
        for f, g in combinations_with_replacement(FEATURES, 2)
    }
    with_y = {f"c_{f}": F.col(f"xy_{f}") / n - F.col(f"m_{f}") * F.col("m") for f in FEATURES}
    scaled = sums.withColumns(means).withColumns(spread | with_y | {"d": F.sqrt(F.greatest(F.col("yy") / n - F.col("m") * F.col("m"), F.lit(0.0)))})
    scaled = scaled.withColumns({f"d_{f}": F.sqrt(f"c_{f}_{f}") for f in FEATURES})
    pull = {f"r_{f}": _over(F.col(f"c_{f}"), F.col(f"d_{f}")) for f in FEATURES}
    alike = {f"g_{_pair(f, g)}": _over(F.col(f"c_{_pair(f, g)}"), F.col(f"d_{f}") * F.col(f"d_{g}")) for f, g in combinations_with_replacement(FEATURES, 2)}
    scaled = scaled.withColumns(pull | alike | {"l2": _over(F.lit(reg * (1 - l1_ratio)), F.col("d"))})

    def sweep(b: Column, _: Column) -> Column:
        now = {f: b[f] for f in FEATURES}
        for f in FEATURES:
            rest = reduce(lambda x, g: x - F.col(f"g_{_pair(f, g)}") * now[g], [g for g in FEATURES if g != f], F.col(f"r_{f}"))
            l1 = F.lit(float(reg * l1_ratio))
            cut = F.when(rest > l1, rest - l1).when(rest < -l1, rest + l1).otherwise(0.0)
            now[f] = _over(cut, F.col(f"g_{f}_{f}") + F.col("l2"))
        return F.struct(*(now[f].alias(f) for f in FEATURES))

    start = F.struct(*(F.lit(0.0).alias(f) for f in FEATURES))
    fitted = scaled.withColumn("b", F.aggregate(F.sequence(F.lit(1), F.lit(max_iter)), start, sweep))
    slopes = fitted.select("n", "m", *(f"m_{f}" for f in FEATURES), *(_over(F.col(f"b.{f}"), F.col(f"d_{f}")).alias(f) for f in FEATURES))
    intercept = reduce(lambda x, f: x - F.col(f) * F.col(f"m_{f}"), FEATURES, F.col("m"))
    return slopes.select(F.col("n").alias("n_rows"), *FEATURES, intercept.alias("intercept"))


def model_coefficients(model: DataFrame) -> DataFrame:
    """One row per feature, and the intercept."""
    terms = [F.struct(F.lit(t).alias("term"), F.col(t).alias("coefficient")) for t in (*FEATURES, "intercept")]
    return model.select(F.inline(F.array(*terms)))


def predicted(model: DataFrame) -> Column:
    """The model's amount for a row with the features; the model enters the plan as a scalar subquery."""
    b = model.select(F.struct(*FEATURES, "intercept")).scalar()
    return reduce(lambda x, f: x + F.col(f) * b[f], FEATURES, b["intercept"])


def future_calendar(spark: SparkSession, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """The ``days`` days after ``as_of`` with their calendar features."""
    today = as_of_column(as_of).cast("date")
    dates = F.sequence(F.date_add(today, 1), F.date_add(today, days))
    day = F.col("predicted_date")
    return spark.range(1).select(F.explode(dates).alias("predicted_date")).select(
        F.concat(F.lit(PREDICTION_PREFIX), F.date_format(day, "yyyyMMdd")).alias("prediction_id"),
        "predicted_date",
        *calendar_columns(day),
        weekday_name(day).alias("weekday_name"),
    )


def forecast(model: DataFrame, calendar: DataFrame, created_at: AsOf = None) -> DataFrame:
    """Forecast records for the days of a calendar."""
    return calendar.select(
        "prediction_id",
        "predicted_date",
        predicted(model).alias("predicted_sales"),
        "day",
        "month",
        F.col("weekday_name").alias("weekday"),
        F.lit(MODEL_NAME).alias("model"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("features_used"),
        F.date_format(as_of_column(created_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
    )


def weekday_forecast(rows: DataFrame, calendar: DataFrame, created_at: AsOf = None) -> DataFrame:
    """Forecast records from the mean amount of each weekday, to two decimals: a baseline for the linear model."""
    means = training_features(rows).groupBy("weekday").agg(F.round(exact_avg("total_amount"), 2).alias("predicted_sales"))
    return calendar.join(means, "weekday", "left").select(
        "prediction_id",
        "predicted_date",
        "predicted_sales",
        "day",
        "month",
        F.col("weekday_name").alias("weekday"),
        F.lit(BASELINE_NAME).alias("model"),
        F.array(F.lit("weekday")).alias("features_used"),
        F.date_format(as_of_column(created_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
    )


def split_holdout(rows: DataFrame, key: str = "order_id", folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, test) split: one fold of the key's MD5 is held out; a null key counts as empty text."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    held_out = F.pmod(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint"), F.lit(folds)) == 0
    return rows.filter(~held_out), rows.filter(held_out)


def model_evaluation(model: DataFrame, features: DataFrame) -> DataFrame:
    """Number of rows, RMSE, MAE and R2 of a model, in one pass over the rows."""
    error = F.col("total_amount") - F.col("predicted")
    scored = features.dropna(subset=[*FEATURES, "total_amount"]).withColumn("predicted", predicted(model)).agg(
        F.count("*").alias("n_rows"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop("total_amount").alias("variance"),
    )
    return scored.select(
        "n_rows",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - F.try_divide("mse", "variance")).alias("r2"),
    )


def read_forecast(predictions: DataFrame) -> DataFrame:
    """Stored forecasts with their date parsed; rows without a date are left out."""
    day = F.col("predicted_date")
    dated = predictions.filter(day.isNotNull() & (day.cast("string") != ""))
    return dated.withColumn("predicted_date", to_day("predicted_date"))


def next_predictions(predictions: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` forecasts by date."""
    columns = ["prediction_id", "predicted_date", "predicted_sales"]
    return read_forecast(predictions).select(*columns).orderBy("predicted_date", "prediction_id").limit(n)


def forecast_summary(predictions: DataFrame) -> DataFrame:
    """Total and mean forecast per model."""
    if "model" not in predictions.columns:  # stored by a single model
        predictions = predictions.withColumn("model", F.lit(MODEL_NAME))
    return predictions.groupBy("model").agg(
        F.count("*").alias("n_days"),
        exact_sum("predicted_sales").alias("total_predicted"),
        exact_avg("predicted_sales").alias("avg_predicted"),
    )


def forecast_trend(summary: DataFrame, delivered_orders: DataFrame) -> DataFrame:
    """Mean forecast against the mean delivered order; no row without a positive history."""
    history = delivered_orders.agg(exact_avg("total_amount")).scalar()
    change = (F.col("avg_predicted") - F.col("historical_avg")) / F.col("historical_avg") * 100
    return (
        summary.withColumn("historical_avg", history)
        .filter(F.col("historical_avg") > 0)
        .select(
            "model",
            "avg_predicted",
            "historical_avg",
            F.abs(change).alias("diff_pct"),
            F.when(change > 0, TREND_UP).otherwise(TREND_DOWN).alias("trend"),
        )
    )


def forecast_vs_history(predictions: DataFrame, history: DataFrame) -> DataFrame:
    """Mean forecast against the mean of recent daily sales; no row without history."""
    forecast_mean = predictions.agg(exact_avg("predicted_sales")).scalar()
    change = (F.col("pred_avg") - F.col("hist_avg")) / F.col("hist_avg") * 100
    return (
        history.agg(exact_avg("daily_sales").alias("hist_avg"))
        .filter(F.col("hist_avg").isNotNull())
        .withColumn("pred_avg", F.coalesce(forecast_mean, F.lit(0.0)))
        .select(
            "hist_avg",
            "pred_avg",
            F.when(F.col("hist_avg") > 0, F.abs(change)).alias("diff_pct"),
            F.when(F.col("hist_avg") > 0, F.when(change > 0, ARROW_UP).otherwise(ARROW_DOWN)).alias("direction"),
        )
    )
