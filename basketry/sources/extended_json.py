"""Document-store exports: JSON lines in which the store marks its own types.

An export has one document per line. Values without a JSON type are objects with a marked key: ids
(``$oid``), times (``$date``: text, milliseconds, or ``$numberLong`` milliseconds) and numbers
(``$numberInt``, ``$numberLong``, ``$numberDouble``, ``$numberDecimal``, as text). All forms of a type
are read, marked or plain. Spark splits the files, parses each line once into a VARIANT and takes the
schema's fields from it, so any store that Spark reads will do and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NumericType, StringType, StructType, TimestampNTZType, TimestampType,
)

FORMAT = "extended-json"

# The keys that mark a type.
OID, UUID, DATE = "$oid", "$uuid", "$date"
NUMBERS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")


def _at(value: Column, *keys: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, "$" + "".join(f'["{k}"]' for k in keys), kind)


def _number(value: Column, kind: DataType) -> Column:
    name = kind.simpleString()
    marked = [_at(value, k).try_cast(name) for k in NUMBERS]
    return F.coalesce(*marked, F.try_variant_get(value, "$", name))


def _time(value: Column) -> Column:
    millis = F.coalesce(_at(value, DATE, "$numberLong").try_cast("bigint"), _at(value, DATE, kind="bigint"))
    text = F.coalesce(_at(value, DATE), F.try_variant_get(value, "$", "string"))
    return F.coalesce(F.timestamp_millis(millis), text.try_cast("timestamp"))


def decoded(value: Column, kind: DataType) -> Column:
    """A VARIANT as a value of the type; null where it has another."""
    if isinstance(kind, StructType):
        fields = [decoded(_at(value, f.name, kind="variant"), f.dataType).alias(f.name) for f in kind]
        return F.when(F.schema_of_variant(value).startswith("OBJECT"), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: decoded(v, kind.elementType))
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return _time(value).cast(kind)
    if isinstance(kind, NumericType):
        return _number(value, kind)
    if isinstance(kind, BooleanType):
        return F.try_variant_get(value, "$", "boolean")
    if isinstance(kind, StringType):
        numbers = [_at(value, k) for k in NUMBERS]
        nested = F.when(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.to_json(value))
        time = F.date_format(F.when(_at(value, DATE, kind="variant").isNotNull(), _time(value)), "yyyy-MM-dd'T'HH:mm:ss.SSSX")
        return F.coalesce(_at(value, OID), _at(value, UUID), time, *numbers, nested, F.try_variant_get(value, "$", "string"))
    raise TypeError(f"an export holds no {kind.simpleString()}")


def parsed_lines(lines: DataFrame, schema: StructType | str, column: str = "value") -> DataFrame:
    """Documents with the fields of the schema from text lines.

    A missing field, a null and a value of another type are null. Blank lines and lines that are no JSON
    object give no row; ``rejected_lines`` counts the latter.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    document = F.try_parse_json(column)
    objects = lines.select(document.alias("document")).filter(F.schema_of_variant("document").startswith("OBJECT"))
    return objects.select(*(decoded(_at(F.col("document"), f.name, kind="variant"), f.dataType).alias(f.name) for f in fields))


def rejected_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines hold something else than a JSON object."""
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT"), F.lit(False))
    return lines.agg(F.count_if((F.trim(column) != "") & ~ok).alias("n_rejected"))


def read_export(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return parsed_lines(spark.read.text(path), schema)


def encoded(value: Column, kind: DataType) -> Column:
    """A value with the mark of its type, to be written as JSON."""
    marked = lambda inner, key: F.when(value.isNotNull(), F.struct(inner.alias(key)))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*(encoded(value[f.name], f.dataType).alias(f.name) for f in kind)))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda v: encoded(v, kind.elementType))
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        millis = F.unix_millis(value.cast("timestamp")).cast("string")
        return marked(F.struct(millis.alias("$numberLong")), DATE)
    for types, key in (((DoubleType, FloatType), "$numberDouble"), ((DecimalType,), "$numberDecimal"), ((LongType,), "$numberLong"), ((IntegerType,), "$numberInt")):
        if isinstance(kind, types):
            return marked(value.cast("string"), key)
    return value


def export_lines(df: DataFrame) -> DataFrame:
    """One line per row in the form that the store exports, nulls kept; times are cut to milliseconds, as the store does."""
    row = F.struct(*(encoded(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def marked_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines hold each mark: what types an export has."""
    found = [F.struct(F.lit(k).alias("mark"), F.count_if(F.contains(column, F.lit(f'"{k}"'))).alias("n_lines")) for k in (OID, UUID, DATE, *NUMBERS)]
    return lines.agg(F.array(*found).alias("marks")).select(F.inline("marks")).filter("n_lines > 0")
