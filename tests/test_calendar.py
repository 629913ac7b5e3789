from __future__ import annotations

import datetime as dt

from basketry.constants import FRENCH_WEEKDAYS
from basketry.functions.calendar import add_calendar, latest, to_day, weekday_name
from basketry.operators.forecast import future_calendar
from conftest import rows_of


def test_features_and_weekend(spark):
    days = [dt.datetime(2024, 2, 25, 23, 59) + dt.timedelta(days=i) for i in range(7)]  # Sunday first
    out = add_calendar(spark.createDataFrame([(d,) for d in days], "date timestamp")).collect()
    assert [r.weekday for r in out] == [1, 2, 3, 4, 5, 6, 7]
    assert [r.is_weekend for r in out] == [1, 0, 0, 0, 0, 0, 1]
    leap = out[4]
    assert (leap.date_formatted, leap.year, leap.month, leap.day, leap.month_year) == (
        dt.date(2024, 2, 29), 2024, 2, 29, "2024-02",
    )


def test_weekday_names_match_python(spark):
    # Python's Monday is 0, the list starts on Sunday.
    days = [dt.date(2024, 12, 28) + dt.timedelta(days=i) for i in range(10)]
    out = spark.createDataFrame([(d,) for d in days], "d date").select("d", weekday_name("d").alias("n"))
    assert all(r.n == FRENCH_WEEKDAYS[(r.d.weekday() + 1) % 7] for r in out.collect())


def test_missing_date_column_uses_as_of(spark):
    df = spark.createDataFrame([("a",)], "order_id string")
    (row,) = add_calendar(df, as_of=dt.date(2023, 5, 6)).collect()
    assert (row.date_formatted, row.weekday, row.is_weekend) == (dt.date(2023, 5, 6), 7, 1)


def test_bad_and_null_dates_become_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("not a date",), (None,)], "date string")
    assert rows_of(df.select(to_day("date"))) == [(None,), (None,), (dt.date(2024, 1, 2),)]
    assert [r.is_weekend for r in add_calendar(df).collect()] == [0, 0, 0]


def test_future_calendar_crosses_month_and_year(spark):
    rows = future_calendar(spark, dt.date(2023, 12, 29), 5).collect()
    assert [r.predicted_date for r in rows] == [dt.date(2023, 12, 29) + dt.timedelta(days=i) for i in range(1, 6)]
    assert rows[2].prediction_id == "PRED-20240101"
    assert (rows[2].day, rows[2].month, rows[2].weekday, rows[2].weekday_name) == (1, 1, 2, "Lundi")


def test_future_calendar_from_data(spark):
    orders = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8),), (dt.datetime(2024, 2, 28, 9),)], "date timestamp")
    rows = future_calendar(spark, latest(orders), 2).collect()
    assert [r.predicted_date for r in rows] == [dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
