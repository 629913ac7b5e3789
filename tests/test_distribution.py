from __future__ import annotations

import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from basketry.operators.distribution import amount_center, exact_median, histogram, median_frame
from conftest import one


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "total_amount double")


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [3.0, 3.0, 3.0],
        [1.0, 1.0, 9.0, 9.0],
        [-7.5, 0.0, 2.5, 1e12],
        [0.0] * 50 + [1e9] * 50,
        [0.01 * i for i in range(101)],
        [1.0, 1.0000000000000002, 1.0000000000000004],
        [-1.7e308, 0.0, 1.7e308],
    ],
)
def test_median_matches_python(spark, values):
    assert exact_median(frame(spark, values)) == statistics.median(values)


def test_median_ignores_nulls_and_nothing(spark):
    assert exact_median(frame(spark, [None, 4.0, None, 2.0])) == 3.0
    assert exact_median(frame(spark, [None])) is None
    assert one(amount_center(frame(spark, []))) == {"mean_amount": None, "median_amount": None}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_median_property(spark, values):
    assert exact_median(frame(spark, values)) == pytest.approx(statistics.median(values), rel=1e-15)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 3.0, 16.0], [float(i) for i in range(31)], [7.0, 7.0]])
def test_histogram_matches_numpy(spark, values):
    counts, edges = np.histogram(values, bins=15)
    rows = histogram(frame(spark, [*values, None])).orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r.high for r in rows] == pytest.approx(edges[1:].tolist())


def test_histogram_of_nothing(spark):
    assert histogram(frame(spark, [])).count() == 0


@pytest.mark.parametrize("odd", [float("inf"), float("-inf"), float("nan"), None])
def test_amounts_off_the_axis_take_no_part(spark, odd):
    df = frame(spark, [1.0, 2.0, odd])
    assert one(amount_center(df)) == {"mean_amount": 1.5, "median_amount": 1.5}
    assert sum(r.n for r in histogram(df).collect()) == 2
    assert exact_median(frame(spark, [odd, odd])) is None


@pytest.mark.parametrize(
    "amount, median",
    [
        ("cast((id * 7919) % 400001 as double)", 200_000.0),
        ("if(id % 3 = 0, 5D, 1D)", 1.0),
        ("if(id < 200000, 1D, 1D + id / 1e12)", 1.0 + 200_000 / 1e12),
        ("case when id < 200000 then -1e300 * id when id = 200000 then 0.25D else 1e300 * id end", 0.25),
        ("case when id % 2 = 0 then double('NaN') when id % 4 = 1 then double('Infinity') else cast(id as double) end", 200_001.0),
    ],
)
def test_median_of_many_rows(spark, amount, median):
    assert exact_median(spark.range(400_001).selectExpr(f"{amount} as total_amount")) == median


def test_median_plan_has_no_window_and_orders_few_values(spark):
    df = spark.range(400_001).selectExpr("cast((id * 7919) % 400001 as double) as total_amount")
    frame = median_frame(df)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan
    assert exact_median(df) == 200_000.0
