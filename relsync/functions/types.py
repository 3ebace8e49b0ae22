"""Type mapping: source Parquet types to the canonical table types, SQL type names to Spark.

The canonical mapping widens: every integer width becomes bigint, every float width
double, every timestamp a timestamp without zone; struct / array / map become JSON;
anything else (decimal, binary, interval, ...) becomes string.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def is_nested(dt: T.DataType) -> bool:
    return isinstance(dt, NESTED)


def canonical_type(dt: T.DataType, json_as: str = "string") -> T.DataType:
    """Table type for a source type (the widening map)."""
    if isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(dt, INTEGRAL):
        return T.LongType()
    if isinstance(dt, FLOATING):
        return T.DoubleType()
    if isinstance(dt, T.BooleanType):
        return T.BooleanType()
    if isinstance(dt, TIMESTAMPS):
        return T.TimestampNTZType()
    if isinstance(dt, T.DateType):
        return T.DateType()
    if is_nested(dt):
        if json_as == "native":
            return dt
        return T.VariantType() if json_as == "variant" else T.StringType()
    if is_unsigned64(dt):
        return T.LongType()
    return T.StringType()


def is_unsigned64(dt: T.DataType) -> bool:
    """Spark reads Parquet unsigned 64-bit integers as decimal(20,0)."""
    return isinstance(dt, T.DecimalType) and dt.precision == 20 and dt.scale == 0


def canonical_cast(col: Column, dt: T.DataType) -> Column:
    """Cast a column of source type ``dt`` to its canonical scalar type.

    Floats go through their shortest decimal text so that float 0.1 becomes double 0.1
    (a plain widening cast would give 0.10000000149011612). Zoned timestamps become their
    UTC wall clock, whatever the session's zone.
    """
    if isinstance(dt, T.FloatType):
        return col.cast("string").cast("double")
    if isinstance(dt, T.TimestampType):
        return utc_wall_clock(col)
    if isinstance(dt, (T.StringType, T.LongType, T.DoubleType, T.BooleanType, T.DateType,
                       T.TimestampNTZType)):
        return col
    target = canonical_type(dt)
    return col.cast(target)


def utc_wall_clock(col: Column) -> Column:
    """A zoned timestamp as a timestamp without zone in UTC, to the microsecond, independent of
    the session's zone (a cast would take the session's)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (F.unix_micros(col).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(secs=seconds)


def widen_floats(dt: T.DataType) -> T.DataType:
    """The same nested type with every float leaf widened to double."""
    if isinstance(dt, T.FloatType):
        return T.DoubleType()
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(widen_floats(dt.elementType), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(widen_floats(dt.keyType), widen_floats(dt.valueType),
                         dt.valueContainsNull)
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, widen_floats(f.dataType), f.nullable)
                             for f in dt.fields])
    return dt


#: Times in JSON text: microseconds kept, zoned ones in UTC whatever the session's zone.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_text(col: Column) -> Column:
    return F.to_json(col, JSON_OPTIONS)


def comparable(col: Column, dt: T.DataType) -> Column:
    """A value that equals another's exactly when the two are equal, of a type that can be
    compared: maps become their sorted entries, variants their JSON text."""
    if isinstance(dt, T.VariantType):
        return F.to_json(col)
    if not _incomparable(dt):
        return col
    if isinstance(dt, T.MapType):
        return F.array_sort(F.transform(F.map_entries(col), lambda e: F.struct(
            comparable(e["key"], dt.keyType).alias("key"), comparable(e["value"], dt.valueType).alias("value"))))
    if isinstance(dt, T.ArrayType):
        return F.transform(col, lambda x: comparable(x, dt.elementType))
    return F.when(col.isNotNull(), F.struct(*[comparable(col.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))


def _incomparable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return True
    if isinstance(dt, T.ArrayType):
        return _incomparable(dt.elementType)
    return isinstance(dt, T.StructType) and any(_incomparable(f.dataType) for f in dt.fields)


def to_json_column(col: Column, json_as: str = "string", dt: T.DataType | None = None) -> Column:
    """Serialise a struct / array / map column; null fields are kept as JSON null.

    With the source type given, float leaves are written as their double value, the
    number a JSON encoder of Python floats prints for a float32 element.
    """
    if json_as == "native":
        return col
    if dt is not None:
        wide = widen_floats(dt)
        if wide != dt:
            col = col.cast(wide)
    text = json_text(col)
    if json_as == "variant":
        return F.parse_json(text)
    return text


# SQL type names accepted in overrides and their Spark type (DDL).
SQL_TYPE_NAMES = {
    "text": "string",
    "string": "string",
    "character varying": "string",
    "varchar": "string",
    "bigint": "bigint",
    "int8": "bigint",
    "integer": "int",
    "int": "int",
    "int4": "int",
    "smallint": "smallint",
    "int2": "smallint",
    "double precision": "double",
    "double": "double",
    "float8": "double",
    "real": "float",
    "float4": "float",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "timestamptz": "timestamp",
    "timestamp with time zone": "timestamp",
    "date": "date",
    "jsonb": "json",
    "json": "json",
    "variant": "variant",
    "bytea": "binary",
    "binary": "binary",
}

_PARAM = re.compile(r"^\s*([a-z][a-z0-9 _]*?)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*$")


def spark_type_for(sql_type: str) -> str:
    """Spark DDL type string for a SQL type name (PostgreSQL spellings accepted).

    "json" is returned for JSON / JSONB so the caller can choose string or variant.
    VARCHAR(n) / CHAR(n) keep their length; NUMERIC(p,s) becomes decimal(p,s).
    Unknown names are passed through for Spark to parse (e.g. "array<string>").
    """
    name = sql_type.strip().lower()
    if name in SQL_TYPE_NAMES:
        return SQL_TYPE_NAMES[name]
    m = _PARAM.match(name)
    if m:
        base, p, s = m.group(1).strip(), m.group(2), m.group(3)
        if base in ("varchar", "character varying"):
            return f"varchar({p})"
        if base in ("char", "character"):
            return f"char({p})"
        if base in ("numeric", "decimal"):
            return f"decimal({p},{s or 0})"
    if name in ("numeric", "decimal"):
        return "decimal(38,18)"
    return name


def override_cast(col: Column, sql_type: str, json_as: str = "string", dt: T.DataType | None = None) -> Column:
    """Apply a user type override to an already projected column; ``dt`` is its source type."""
    target = spark_type_for(sql_type)
    if dt is not None and is_nested(dt) and json_as == "native":
        # a nested value kept as it is: JSON text or a variant is made from the value itself
        if target in ("json", "variant"):
            return col if target == "json" else F.parse_json(json_text(col))
        if target == "string":
            return json_text(col)
    if target == "json":
        return F.parse_json(col.cast("string")) if json_as == "variant" else col
    if target == "variant":
        return col if json_as == "variant" and dt is not None and is_nested(dt) else F.parse_json(col.cast("string"))
    m = re.match(r"^(var)?char\((\d+)\)$", target)
    if m:
        # Spark casts to (var)char as plain strings; enforce the length like a table column.
        n = int(m.group(2))
        s = col.cast("string")
        return F.when(s.isNull() | (F.length(s) <= n), s).otherwise(
            F.raise_error(F.concat(F.lit(f"value exceeds {target}: "), s))
        ).cast("string")
    return col.cast(target)


def type_name(dt: T.DataType) -> str:
    """Stable lower-case type name used by the schema diff."""
    return dt.simpleString().lower()
