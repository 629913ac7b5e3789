"""Result sinks: analysis tables, forecasts and JSON export.

A table in a directory is written beside its place and put there when it is complete, so that a failed
write leaves the old table as it was. A reader of the old files meets a gap of two renames at most; on
an object store a rename is a copy, so the gap there is as long as the copy.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, MapType, StructType, TimestampNTZType, TimestampType

from basketry.constants import RESULT_PREFIX
from basketry.sources.readers import READ_ERRORS

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Target:
    """Where a result goes: a directory per table, or a database collection."""

    base: str | None = None
    fmt: str = "parquet"
    options: Mapping[str, Any] | None = None

    def write(self, df: DataFrame, name: str, keep_empty: bool = True) -> int:
        """Replace a table by df, and say how many rows it has. Without ``keep_empty`` an empty df changes nothing.

        df is evaluated once: its rows are counted as they are written. Only a database collection has
        no place beside it; there an unwanted empty df is found by a look for a first row.
        """
        counted = Observation()
        ready = flat_ready(df) if self.fmt == "csv" else df
        if self.base is None and not keep_empty and df.isEmpty():
            return 0
        rows = ready.observe(counted, F.count(F.lit(1)).alias("n"))
        writer = rows.write.format(self.fmt).mode("overwrite").options(**(self.options or {}))
        if self.base is None:
            writer.option("collection", name).save()
            return counted.get["n"]
        staged = f"{self.base}/.{name}-{uuid.uuid4().hex[:12]}"
        try:
            writer.save(staged)
            if keep_empty or counted.get["n"]:
                _put_in_place(df.sparkSession, staged, f"{self.base}/{name}")
            return counted.get["n"]
        finally:
            _remove(df.sparkSession, staged)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


def _remove(spark: SparkSession, path: str) -> None:
    fs, make = _file_system(spark, path)
    if fs.exists(make(path)):
        fs.delete(make(path), True)


def _put_in_place(spark: SparkSession, staged: str, place: str) -> None:
    """Rename a complete table to its place; the one there goes aside first, and comes back if that fails."""
    fs, make = _file_system(spark, place)
    aside = f"{staged}-before"
    old = fs.exists(make(place))
    if old and not fs.rename(make(place), make(aside)):
        raise OSError(f"{place} cannot be replaced")
    if not fs.rename(make(staged), make(place)):
        if old:
            fs.rename(make(aside), make(place))
        raise OSError(f"{staged} cannot be put in place")
    if old:
        fs.delete(make(aside), True)


def replace_table(df: DataFrame, name: str, target: Target) -> None:
    """Replace the whole content of a table, for example the stored forecast; the old one stays if this fails."""
    target.write(df, name)


def save_results(
    results: Mapping[str, DataFrame | None],
    target: Target,
    alternative: Target | None = None,
    prefix: str = RESULT_PREFIX,
) -> dict[str, str]:
    """Save each non-empty result as ``<prefix><name>``; one failure stops only itself.

    A result is evaluated once, by the write, which counts its rows; an empty one leaves no table and
    touches none. Returns ``saved``, ``saved (alternative)``, ``empty`` or ``failed: ...`` per result.
    """
    outcome = {}
    for name, df in results.items():
        outcome[name] = "empty" if df is None else _save_one(df, prefix + name, target, alternative)
    return outcome


def _save_one(df: DataFrame, table: str, target: Target, alternative: Target | None) -> str:
    failure = ""
    for place, done in ((target, "saved"), (alternative, "saved (alternative)")):
        if place is None:
            continue
        try:
            return done if place.write(df, table, keep_empty=False) else "empty"
        except (*READ_ERRORS, OSError) as error:
            log.error("saving %s failed: %s", table, str(error).splitlines()[0])
            failure = f"failed: {str(error).splitlines()[0]}"
    return failure


def flat_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that hold flat columns only."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    )


def json_ready(df: DataFrame) -> DataFrame:
    """Dates, timestamps and a store's own ``_id`` as plain strings."""

    def plain(field) -> bool:
        is_time = isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType))
        return is_time or (field.name == "_id" and isinstance(field.dataType, StructType))

    return df.select(
        [F.col(f.name).cast("string").alias(f.name) if plain(f) else F.col(f.name) for f in df.schema]
    )


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON document per row, nulls kept."""
    ready = json_ready(df)
    return ready.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def export_json(df: DataFrame, path: str) -> str:
    """Distributed JSON Lines export; every task writes its own part file."""
    json_ready(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
