"""Table readers for any Spark source."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketry.schemas import COLLECTIONS
from basketry.sources import extended_json

log = logging.getLogger(__name__)

READ_ERRORS = (PySparkException, Py4JJavaError)


def load_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Read one table or collection.

    File formats take a ``path``; database sources take their own options, for
    example ``fmt="mongodb"`` with ``database=`` and ``collection=`` when that
    connector is on the cluster's classpath. ``fmt="extended-json"`` reads what a document store
    exported, with the store's types; it needs the schema.
    """
    if fmt == extended_json.FORMAT:
        return extended_json.read_export(spark, path, schema)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def load_first(
    spark: SparkSession,
    candidates: Iterable[Mapping[str, Any]],
    schema: StructType | str,
    failed: list[str] | None = None,
) -> DataFrame:
    """The first candidate (keyword arguments of ``load_table``) that resolves.

    When none does the result is empty but typed, so later operators still plan; ``failed`` then gets
    the last reason.
    """
    reason = "no candidate"
    for candidate in candidates:
        try:
            return load_table(spark, **{"schema": schema, **candidate})
        except READ_ERRORS as error:
            reason = str(error).splitlines()[0]
            log.warning("source %s not readable: %s", dict(candidate), reason)
    if failed is not None:
        failed.append(reason)
    return spark.createDataFrame([], schema)


def load_collections(
    spark: SparkSession, locate: Iterable[Callable[[str], Mapping[str, Any]]], missing: list[str] | None = None
) -> dict[str, DataFrame]:
    """Orders, products and customers, each from the first way of locating it that works.

    A locator turns a collection name into keyword arguments of ``load_table``. Names of collections
    that no way leads to, and which are empty therefore, are added to ``missing``.
    """
    ways = list(locate)
    found = {}
    for name, schema in COLLECTIONS.items():
        failed: list[str] = []
        found[name] = load_first(spark, [way(name) for way in ways], schema, failed)
        if missing is not None and failed:
            missing.append(name)
    return found


def table_exists(spark: SparkSession, name: str, fmt: str | None = None) -> bool:
    """Whether a catalog table, or with ``fmt`` a dataset at that path, can be read."""
    if fmt is None:
        return spark.catalog.tableExists(name)
    try:
        load_table(spark, name, fmt)
        return True
    except READ_ERRORS:
        return False


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))
