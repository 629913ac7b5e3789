"""Calendar features of order dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.constants import FRENCH_WEEKDAYS

AsOf = Column | dt.date | dt.datetime | None


def as_of_column(as_of: AsOf) -> Column:
    """A point in time as a Column: a literal, a scalar subquery, or today."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def to_day(column: Column | str) -> Column:
    """Calendar day; unparsable strings become null instead of failing the job."""
    c = F.col(column) if isinstance(column, str) else column
    return c.try_cast("date")


def dated(df: DataFrame, column: str = "date") -> DataFrame:
    """Text dates as timestamps, unparsable ones as null; columns of another type stay as they are."""
    if column in df.columns and df.schema[column].dataType.simpleString() == "string":
        return df.withColumn(column, F.col(column).try_cast("timestamp"))
    return df


def month_key(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM")


def weekday_name(day: Column | str, names: tuple[str, ...] = FRENCH_WEEKDAYS) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(day))


def add_calendar(df: DataFrame, column: str = "date", as_of: AsOf = None) -> DataFrame:
    """Add day, month, year, weekday (Sunday = 1), weekend flag and ``yyyy-MM``.

    When ``column`` is absent every row gets the calendar of ``as_of``.
    """
    day = to_day(column) if column in df.columns else as_of_column(as_of).cast("date")
    d = F.col("date_formatted")
    return (
        df.withColumn("date_formatted", day)
        .withColumns(
            {
                "year": F.year(d),
                "month": F.month(d),
                "day": F.dayofmonth(d),
                "weekday": F.dayofweek(d),
                "is_weekend": F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0),
                "month_year": month_key(d),
            }
        )
    )


def latest(df: DataFrame, column: str = "date") -> Column:
    """The largest value of a column, as a scalar subquery inside the same plan."""
    return df.agg(F.max(column)).scalar()
