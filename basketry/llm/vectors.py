"""Rows of a vector table that take part in a search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, zero: bool = True) -> DataFrame:
    """(id long, v array<double>), one row per id.

    Null vectors, vectors with a null, NaN or infinite component, rows without id and, if ``zero`` is
    false, vectors of zeros are left out. Repeated rows count once; of different vectors under one id
    the smallest (in array order) counts. Other columns are ignored.
    """
    v = F.col(vec_col).cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(good)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))
