"""Looking up records for a few rows in a large table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def attach_record(few: DataFrame, table: DataFrame, key: str, record: Column) -> DataFrame:
    """Add one ``record`` struct per row of ``few``, null where the table has none.

    ``few`` must be cut to a fixed number of rows. It is held as one array in a
    scalar subquery: evaluated once, it both yields the rows and filters the
    table while that is scanned. What is left of the table is reduced to one
    record per key (a re-run of a loader may have inserted a key twice), so the
    broadcast side has no more rows than ``few``.
    """
    held = few.agg(F.collect_list(F.struct(*few.columns))).scalar()
    found = (
        table.filter(F.array_contains(held[key], F.col(key))).groupBy(key).agg(F.min(record).alias("record"))
    )
    rows = table.sparkSession.range(1).select(F.inline(held))
    return rows.join(F.broadcast(found), key, "left")
