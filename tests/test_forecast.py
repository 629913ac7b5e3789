from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from basketry.operators import forecast as fc
from basketry.plans.analysis import run_forecast
from basketry.sources.dataset import load_dataset
from conftest import ORDER_FIELDS, one, rows_of


def make_orders(spark, delivered, others):
    rows = [
        (f"o{i}", "c", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 10.0 * i, "carte", "livré" if i < delivered else "annulé")
        for i in range(delivered + others)
    ]
    return spark.createDataFrame(rows, ORDER_FIELDS)


@pytest.mark.parametrize("delivered, kept", [(4, 10), (5, 5), (6, 6)])
def test_fallback_below_five_delivered(spark, delivered, kept):
    assert fc.training_rows(make_orders(spark, delivered, 10 - delivered)).count() == kept


def test_fallback_keeps_orders_without_status(spark):
    orders = make_orders(spark, 2, 2).withColumn("status", F.when(F.col("status") == "livré", "livré"))
    assert fc.training_rows(orders).count() == 4


def noisy_features(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    day, weekday, month = rng.integers(1, 32, n), rng.integers(1, 8, n), rng.integers(1, 13, n)
    amount = 40 + 3 * day - 12 * weekday + 7 * month + rng.normal(0, 25, n)
    rows = [(float(a), int(d), int(w), int(m)) for a, d, w, m in zip(amount, day, weekday, month)]
    return spark.createDataFrame(rows, "total_amount double, day int, weekday int, month int")


def row_level_fit(features, reg, ratio):
    assembler = VectorAssembler(inputCols=list(fc.FEATURES), outputCol="features")
    regression = LinearRegression(
        featuresCol="features", labelCol="total_amount", maxIter=100, regParam=reg, elasticNetParam=ratio
    )
    return Pipeline(stages=[assembler, regression]).fit(features)


def coefficients(model):
    """(day, weekday, month, intercept)"""
    return [r.coefficient for r in fc.model_coefficients(model).collect()]


@pytest.mark.parametrize("reg, ratio", [(0.01, 0.8), (5.0, 0.8), (5.0, 0.1), (20.0, 0.0), (0.0, 0.8), (3.0, 1.0)])
def test_fit_on_sums_equals_row_level_fit(spark, reg, ratio):
    features = noisy_features(spark)
    theirs = row_level_fit(features, reg, ratio).stages[-1]
    found = coefficients(fc.fit_model(features, reg=reg, l1_ratio=ratio))
    assert found == pytest.approx([*theirs.coefficients.toArray(), theirs.intercept], rel=1e-6)


def test_fit_equals_row_level_fit_on_the_tables(spark, sf_dir):
    features = fc.training_features(fc.training_rows(load_dataset(spark, sf_dir).orders, F.col("status") == "F"))
    theirs = row_level_fit(features, 0.01, 0.8).stages[-1]
    assert coefficients(fc.fit_model(features)) == pytest.approx([*theirs.coefficients.toArray(), theirs.intercept], rel=1e-6)


def test_unregularised_fit_equals_numpy(spark):
    features = noisy_features(spark)
    data = features.toPandas()
    x = np.column_stack([data[list(fc.FEATURES)], np.ones(len(data))])
    expected = np.linalg.lstsq(x, data["total_amount"], rcond=None)[0]
    assert coefficients(fc.fit_model(features, reg=0.0)) == pytest.approx(expected.tolist(), rel=1e-9)


def test_fit_does_not_depend_on_the_partitioning(spark):
    features = noisy_features(spark)
    found = {tuple(coefficients(fc.fit_model(features.repartition(n, *by)))) for n, by in ((1, []), (7, []), (5, ["day"]))}
    assert len(found) == 1


def test_sums_of_parts_add_up(spark):
    features = noisy_features(spark, 500).withColumn("total_amount", F.round("total_amount", 2))
    whole = one(fc.gram(fc.feature_cells(features)))
    parts = [one(fc.gram(fc.feature_cells(features.filter(c)))) for c in ("day < 9", "day >= 9")]
    assert all(whole[k] == pytest.approx(parts[0][k] + parts[1][k], rel=1e-15) for k in whole)


def test_a_constant_feature_takes_no_part(spark):
    flat = noisy_features(spark, 300).withColumn("month", F.lit(5))
    day, weekday, month, intercept = coefficients(fc.fit_model(flat, reg=0.0))
    assert month == 0.0 and day == pytest.approx(3, abs=1) and weekday == pytest.approx(-12, abs=3)


def test_too_few_rows_is_an_error(spark):
    features = noisy_features(spark, 3)
    assert fc.fit_model(features).first()["n_rows"] == 3
    for n in (2, 0):
        with pytest.raises(PySparkException, match="at least 3"):
            fc.fit_model(features.limit(n)).collect()


def test_rows_with_nulls_and_without_finite_amount_are_skipped(spark):
    features = noisy_features(spark, 200)
    holes = features.limit(1).withColumn("day", F.lit(None).cast("int"))
    for amount in ("NaN", "Infinity", "-Infinity"):
        holes = holes.unionByName(features.limit(1).withColumn("total_amount", F.lit(amount).cast("double")))
    assert coefficients(fc.fit_model(features)) == coefficients(fc.fit_model(features.unionByName(holes)))


def test_constant_amounts(spark):
    flat = noisy_features(spark, 50).withColumn("total_amount", F.lit(12.5))
    calendar = fc.future_calendar(spark, dt.date(2024, 1, 1), 2)
    assert [r.predicted_sales for r in fc.forecast(fc.fit_model(flat), calendar).collect()] == pytest.approx([12.5, 12.5])


def test_nothing_runs_before_a_result_is_asked_for(spark):
    orders = make_orders(spark, 30, 5)
    spark.sparkContext.setJobGroup("lazy", "building a forecast")
    try:
        model = fc.fit_model(fc.training_features(fc.training_rows(orders)))
        out = fc.forecast(model, fc.future_calendar(spark, dt.date(2024, 1, 1), 2))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
        assert out.count() == 2 and spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fallback_reads_other_orders_only_if_needed(spark, sf_dir):
    orders = load_dataset(spark, sf_dir).orders
    for status, scans in (("F", 1), ("none", 3)):  # with too few delivered orders: these, the count for the gate, and the others
        rows = fc.training_rows(orders, F.col("status") == status)
        assert rows.count() == orders.filter(F.col("status") == status).count() or scans > 1
        rows.collect()
        final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan") == scans
        assert f"EqualTo(o_orderstatus,{status})" in final


def test_forecast_records(spark):
    as_of = dt.datetime(2024, 2, 27, 10, 30)
    out = run_forecast(make_orders(spark, 30, 5), days=4, as_of=as_of).orderBy("predicted_date").collect()
    assert [r.predicted_date for r in out] == [dt.date(2024, 2, 28) + dt.timedelta(days=i) for i in range(4)]
    assert out[1].prediction_id == "PRED-20240229" and out[1].weekday == "Jeudi"
    assert out[0].features_used == ["day", "weekday", "month"] and out[0].model == "LinearRegression"
    assert out[0].created_at == "2024-02-27T10:30:00.000000"


def test_daily_grain_sums_days(spark):
    rows = [("a", "c", dt.datetime(2024, 1, 1, h), 5.0, "carte", "livré") for h in range(3)]
    daily = fc.training_features(spark.createDataFrame(rows, ORDER_FIELDS), grain="day")
    assert rows_of(daily) == [(15.0, 1, 2, 1)]
    with pytest.raises(ValueError, match="grain"):
        fc.training_features(daily.withColumn("date", F.lit(None)), grain="week")


def test_evaluation_equals_evaluator(spark):
    features = noisy_features(spark)
    model = fc.fit_model(features)
    ours = one(fc.model_evaluation(model, features))
    predicted = features.withColumn("prediction", fc.predicted(model))
    for metric in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="total_amount", predictionCol="prediction", metricName=metric)
        assert ours[metric] == pytest.approx(evaluator.evaluate(predicted), rel=1e-9)


def test_holdout_is_a_stable_partition(spark):
    orders = make_orders(spark, 300, 0)
    train, test = fc.split_holdout(orders)
    assert train.count() + test.count() == 300 and 30 < test.count() < 90
    assert rows_of(test) == rows_of(fc.split_holdout(orders.repartition(5))[1])


PREDICTIONS = [
    ("p1", "2024-01-02", 10.0, "LinearRegression"),
    ("p2", "2024-01-01", 20.0, "LinearRegression"),
    ("p3", "", 99.0, "LinearRegression"),
    ("p4", None, 99.0, "Other"),
]


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(
        PREDICTIONS, "prediction_id string, predicted_date string, predicted_sales double, model string"
    )


def test_stored_forecasts_with_text_dates(predictions):
    out = fc.next_predictions(predictions, 5).collect()
    assert [(r.prediction_id, r.predicted_date) for r in out] == [
        ("p2", dt.date(2024, 1, 1)), ("p1", dt.date(2024, 1, 2)),
    ]


def test_summary_and_trend(spark, predictions):
    summary = fc.forecast_summary(predictions.limit(2))
    assert rows_of(summary) == [("LinearRegression", 2, 30.0, 15.0)]
    orders = make_orders(spark, 5, 0)  # mean 20
    assert one(fc.forecast_trend(summary, orders)) == {
        "model": "LinearRegression", "avg_predicted": 15.0, "historical_avg": 20.0, "diff_pct": 25.0, "trend": "BAISSE",
    }
    assert fc.forecast_trend(summary, orders.limit(0)).isEmpty()
    assert fc.forecast_trend(summary, orders.withColumn("total_amount", F.lit(0.0))).isEmpty()


def test_forecast_vs_history(spark, predictions):
    history = spark.createDataFrame([("2024-01-01", 10.0), ("2024-01-02", 14.0)], "day string, daily_sales double")
    assert one(fc.forecast_vs_history(predictions.limit(2), history)) == {
        "hist_avg": 12.0, "pred_avg": 15.0, "diff_pct": 25.0, "direction": "↗",
    }
    assert fc.forecast_vs_history(predictions, history.limit(0)).isEmpty()
    assert one(fc.forecast_vs_history(predictions.limit(0), history))["pred_avg"] == 0.0
