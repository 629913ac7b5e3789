"""The three ways a delivered order is recognised, plus recency.

They accept different spellings on purpose: LIKE takes "livre" without the
accent but not capitals, equality/contains takes only "livré", and the regex
takes any case but needs the accent. A null status matches none of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from basketry.constants import DELIVERED_PATTERNS, DELIVERED_VALUE
from basketry.functions.calendar import AsOf, as_of_column


def delivered_like(status: str = "status", patterns: tuple[str, ...] = DELIVERED_PATTERNS) -> Column:
    """Any of the LIKE patterns; ``%x%`` reaches the parquet scan as a pushed filter."""
    return reduce(or_, (F.col(status).like(p) for p in patterns))


def delivered_contains(status: str = "status", value: str = DELIVERED_VALUE) -> Column:
    return (F.col(status) == value) | F.col(status).contains(value)


def delivered_regex(status: str = "status", value: str = DELIVERED_VALUE) -> Column:
    """Case-insensitive match; ``u`` makes the folding cover accented letters."""
    return F.col(status).rlike(f"(?iu){value}")


def since_days(column: str, days: int, as_of: AsOf = None) -> Column:
    """Rows at or after ``as_of`` minus ``days``, keeping the time of day."""
    return F.col(column) >= as_of_column(as_of) - F.make_dt_interval(F.lit(days))
