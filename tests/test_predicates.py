from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.functions.columns import MissingColumns, has_columns, label_or, require_columns
from basketry.functions.predicates import delivered_contains, delivered_like, delivered_regex, since_days
from conftest import rows_of

STATUSES = ["livré", "Livré", "LIVRÉ", "livre", "delivered", "Delivered", "en cours", "annulé", None, ""]


@pytest.fixture(scope="module")
def statuses(spark):
    return spark.createDataFrame([(s,) for s in STATUSES], "status string")


@pytest.mark.parametrize(
    "predicate, expected",
    [
        (delivered_like, {"livré", "Livré", "livre", "delivered", "Delivered"}),
        (delivered_contains, {"livré"}),
        (delivered_regex, {"livré", "Livré", "LIVRÉ"}),
    ],
)
def test_spellings(statuses, predicate, expected):
    assert {r.status for r in statuses.filter(predicate()).collect()} == expected


def test_regex_matches_inside_text(spark):
    df = spark.createDataFrame([("colis LIVRÉ hier",)], "status string")
    assert df.filter(delivered_regex()).count() == 1


def test_label_or(statuses):
    labels = {r[0] for r in statuses.select(label_or("status", "Inconnu")).collect()}
    assert "Inconnu" in labels and None not in labels and "" not in labels


def test_since_days_keeps_time_of_day(spark):
    as_of = dt.datetime(2024, 3, 31, 12, 0)
    rows = [(dt.datetime(2024, 3, 1, 11, 59),), (dt.datetime(2024, 3, 1, 12, 0),), (dt.datetime(2025, 1, 1),)]
    kept = spark.createDataFrame(rows, "date timestamp").filter(since_days("date", 30, as_of))
    assert rows_of(kept) == rows[1:]


def test_column_guards(statuses):
    assert has_columns(statuses, "status") and not has_columns(statuses, "status", "x")
    with pytest.raises(MissingColumns, match="'x'.*status"):
        require_columns(statuses, "status", "x")


def test_like_is_pushed_to_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").filter(delivered_like("o_orderstatus", ("%F%", "%G%")))
    assert "StringContains" in df._jdf.queryExecution().executedPlan().toString()
    assert df.select(F.lit(1)).count() > 0
