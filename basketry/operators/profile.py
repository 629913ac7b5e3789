"""Table profiles: dimensions, previews, missing values, search, periods."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from basketry.functions.calendar import to_day
from basketry.functions.columns import MissingColumns, require_columns


def collection_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    profiles = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("collection"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def schema_listing(name: str, df: DataFrame) -> DataFrame:
    """Ordinal, name and type of every column, beside the table's row count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(df.schema, 1)
        ]
    )
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("collection"), F.inline(fields), "n_rows"
    )


def orderable(df: DataFrame) -> list[str]:
    """Columns that rows can be sorted by."""
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def preview(df: DataFrame, key: str | list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows by a key, or by several columns."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*[F.col(f"`{k}`") for k in keys]).limit(n) if keys else df.limit(n)


def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percentage of each column that has nulls, from one scan."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("n_missing"))
                for c in df.columns
            ]
        ).alias("columns"),
    )
    return (
        counts.select("n_rows", F.inline("columns"))
        .filter(F.col("n_missing") > 0)
        .select(
            "column_name",
            "n_missing",
            (F.col("n_missing") * F.lit(100.0) / F.col("n_rows")).alias("pct_missing"),
        )
    )


def date_rejects(df: DataFrame, column: str) -> DataFrame:
    """How many non-null values of a text column are not dates, and so count as missing days."""
    require_columns(df, column)
    rejected = F.col(column).isNotNull() & to_day(column).isNull()
    return df.agg(F.count_if(rejected).alias("n_rejected"))


def _searchable(df: DataFrame, field: str) -> Column:
    if field not in df.columns:
        raise MissingColumns(f"no field {field!r}; available columns: {df.columns}")
    nested = isinstance(df.schema[field].dataType, (ArrayType, MapType, StructType))
    return F.to_json(field) if nested else F.col(field).cast("string")


def search(df: DataFrame, field: str, value: str) -> DataFrame:
    """Rows whose field contains the text; nested fields are searched as JSON."""
    return df.filter(_searchable(df, field).contains(value))


def search_hits(df: DataFrame, field: str, value: str) -> DataFrame:
    """How many rows a search finds."""
    return search(df, field, value).agg(F.count("*").alias("n_hits"))


def period(df: DataFrame, column: str, first: str = "first", last: str = "last") -> DataFrame:
    """Earliest and latest value of a date column."""
    require_columns(df, column)
    return df.agg(F.min(column).alias(first), F.max(column).alias(last))
