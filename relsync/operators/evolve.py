"""Schema drift between a new snapshot and the current table, and additive alignment.

Evolution is additive: new columns are added (nullable, sorted by name), a changed type
keeps the table's type (values are cast to it under ANSI store rules), and columns gone
from the new snapshot are kept in the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.functions.types import type_name, utc_wall_clock

DIFF_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("staging_type", T.StringType(), True),
        T.StructField("final_type", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class SchemaDiff:
    """Column sets of a drift check. Names compare case-insensitively, as Spark does."""

    same: tuple[str, ...]
    type_changed: tuple[str, ...]
    added: tuple[str, ...]  # in staging only, sorted by name
    removed: tuple[str, ...]  # in final only, in final order
    final_types: dict
    staging_types: dict

    @property
    def common(self) -> tuple[str, ...]:
        return self.same + self.type_changed

    def rows(self) -> list[tuple]:
        out = []
        for c in self.same:
            out.append((c, "same", self.staging_types[c.lower()], self.final_types[c.lower()]))
        for c in self.type_changed:
            out.append((c, "type_changed", self.staging_types[c.lower()],
                        self.final_types[c.lower()]))
        for c in self.added:
            out.append((c, "added", self.staging_types[c.lower()], None))
        for c in self.removed:
            out.append((c, "removed", None, self.final_types[c.lower()]))
        return out


def diff_schemas(staging: T.StructType, final: T.StructType) -> SchemaDiff:
    s_types = {f.name.lower(): type_name(f.dataType) for f in staging.fields}
    f_types = {f.name.lower(): type_name(f.dataType) for f in final.fields}
    same, changed, removed = [], [], []
    for f in final.fields:
        key = f.name.lower()
        if key not in s_types:
            removed.append(f.name)
        elif s_types[key] == f_types[key]:
            same.append(f.name)
        else:
            changed.append(f.name)
    added = sorted((f.name for f in staging.fields if f.name.lower() not in f_types),
                   key=str.lower)
    return SchemaDiff(tuple(same), tuple(changed), tuple(added), tuple(removed), f_types, s_types)


def non_null_counts(df: DataFrame, name: str) -> DataFrame:
    """``(column, <name>)``: non-null values per column, from one global aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column", name)


def schema_diff(spark: SparkSession, staging: DataFrame, final: DataFrame,
                counts: bool = False) -> DataFrame:
    """``(column, status, staging_type, final_type)``; status is same / type_changed / added / removed.

    Built from the two schemas alone (analysis, no scan). With ``counts`` each side's
    non-null values per column are added (``staging_non_null``, ``final_non_null``): one
    pass over each snapshot, partially aggregated per task, so a column that arrives
    empty shows up next to its type.
    """
    d = diff_schemas(staging.schema, final.schema)
    out = spark.createDataFrame(d.rows(), DIFF_SCHEMA)
    if not counts:
        return out
    s = non_null_counts(staging, "staging_non_null")
    f = non_null_counts(final, "final_non_null")
    key = F.lower(F.col("column"))
    return (out.join(s.withColumn("__k", key).drop("column"), key == F.col("__k"), "left")
            .drop("__k")
            .join(f.withColumn("__k", key).drop("column"), key == F.col("__k"), "left")
            .drop("__k"))


def align(final: DataFrame, staging_schema: T.StructType) -> DataFrame:
    """The final table with the staging-only columns added as typed NULLs (sorted by name)."""
    d = diff_schemas(staging_schema, final.schema)
    by_name = {f.name.lower(): f for f in staging_schema.fields}
    extra = [F.lit(None).cast(by_name[c.lower()].dataType).alias(c) for c in d.added]
    return final.select(*[F.col(f"`{c}`") for c in final.columns], *extra)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def store_assignable(src: T.DataType, dst: T.DataType) -> bool:
    """Whether values of ``src`` may be stored in a table column of type ``dst``: same type,
    number to number, date or time to one, any scalar but binary to string. What a value
    would lose is checked per value (``store_cast``). Nested values are not stored as text,
    since their display text is no JSON, nor times without zone as zoned ones, since their
    zone is unknown."""
    if src == dst or isinstance(src, T.NullType):
        return True
    if isinstance(dst, (T.StringType, T.VarcharType, T.CharType)):
        return not isinstance(src, (T.BinaryType, T.StructType, T.ArrayType, T.MapType, T.VariantType))
    if isinstance(src, _NUMERIC) and isinstance(dst, _NUMERIC):
        return True
    if isinstance(src, _DATETIME) and isinstance(dst, _DATETIME):
        return isinstance(src, T.TimestampType) or not isinstance(dst, T.TimestampType)
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return store_assignable(src.elementType, dst.elementType)
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        return len(src.fields) == len(dst.fields) and all(
            store_assignable(a.dataType, b.dataType) for a, b in zip(src.fields, dst.fields))
    return False


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def store_cast(col: Column, src: T.DataType, dst: T.DataType, name: str) -> Column:
    """A value of type ``src`` in a table column of type ``dst``, or an error where it would
    lose something: a fraction in an integer, a time of day in a date, a number out of range.
    Zoned timestamps are stored without zone, or as dates, by their UTC wall clock."""
    def checked(lossless: Column, value: Column) -> Column:
        return F.when(col.isNull() | lossless, value).otherwise(F.raise_error(F.concat(
            F.lit(f"column {name!r}: the table's {dst.simpleString()} column cannot hold "), col.cast("string"))))

    if isinstance(src, (T.FloatType, T.DoubleType, T.DecimalType)) and isinstance(dst, _INTEGRAL):
        return checked(col == F.floor(col), col.cast(dst)).cast(dst)
    if isinstance(src, T.DecimalType) and isinstance(dst, T.DecimalType) and src.scale > dst.scale:
        return checked(col == F.round(col, dst.scale), col.cast(dst)).cast(dst)
    if isinstance(src, T.TimestampType) and isinstance(dst, (T.TimestampNTZType, T.DateType)):
        col, src = utc_wall_clock(col), T.TimestampNTZType()
    if isinstance(src, T.TimestampNTZType) and isinstance(dst, T.DateType):
        return checked(col == F.date_trunc("day", col).cast("timestamp_ntz"), col.cast(dst)).cast(dst)
    return col.cast(dst)


def conform(staging: DataFrame, final_schema: T.StructType, carried: DataFrame | None = None) -> DataFrame:
    """Shape merged rows like the evolved table: final's columns in final's order and types,
    then the added columns sorted by name.

    Columns only in the final table come from ``carried`` (already joined in) or are NULL.
    A value that the table's type cannot hold as it is (out of range, a fraction in an integer,
    a time of day in a date) fails the write instead of silently changing data.
    """
    d = diff_schemas(staging.schema, final_schema)
    s_types = {f.name.lower(): f.dataType for f in staging.schema.fields}
    for f in final_schema.fields:
        src = s_types.get(f.name.lower())
        if f.name in d.type_changed and not store_assignable(src, f.dataType):
            raise TypeError(
                f"column {f.name!r}: values of type {src.simpleString()} cannot be stored in "
                f"the table's {f.dataType.simpleString()} column")
    present = {c.lower() for c in staging.columns}
    carried_names = {c.lower() for c in (carried.columns if carried is not None else [])}
    cols: list[Column] = []
    for f in final_schema.fields:
        if f.name.lower() in present:
            src = F.col(f"`{f.name}`")
            if f.name in d.type_changed:
                src = store_cast(src, s_types[f.name.lower()], f.dataType, f.name)
            cols.append(src.alias(f.name))
        elif f.name.lower() in carried_names:
            cols.append(F.col(f"`{f.name}`").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    cols += [F.col(f"`{c}`").alias(c) for c in d.added]
    return (carried if carried is not None else staging).select(*cols)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames of different shape by column name; absent columns read NULL."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
