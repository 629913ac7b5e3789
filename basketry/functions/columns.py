"""Guards for optional and required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class MissingColumns(ValueError):
    """A required column is absent from the input frame."""


def has_columns(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing {missing}; available columns: {df.columns}")


def first_rows(ordered: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows, or with None all of them."""
    return ordered if n is None else ordered.limit(n)


def label_or(column: Column | str, label: str) -> Column:
    """Replace a null or empty label."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(c)
