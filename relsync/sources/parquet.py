"""Schema inference and the multi-file Parquet scan of a dataset.

The schema comes from the first file (by name). Whether the other files agree is
checked from their footers only, in parallel tasks, in one of three modes:

strict  every file must hold every column of the first file, nested fields included, at a
        type that reads as the first file's (extra columns are ignored)
merge   union of all columns, each at its widest type (int < bigint < double, structs field
        by field); a column missing in a file reads NULL
first   the first file's schema is imposed; missing columns read NULL

Merge mode reads every footer once: each task gives one row per column and nested field of its files
(place, type, order), and one aggregation unites them, in any order of the files, so the number of
jobs does not grow with the number of different footers.

Column names compare case-insensitively, as Spark does.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.functions.types import type_name
from relsync.sources.files import parquet_schema
from relsync.sources.inventory import file_inventory
from relsync.sources.remote import read_remote

MODES = ("strict", "merge", "first")


class SchemaMismatch(ValueError):
    pass


def infer_schema(spark: SparkSession, files: Sequence[str]) -> T.StructType:
    """Schema of the first file; an empty list is an error."""
    if not files:
        raise ValueError("no files to infer a schema from")
    return spark.read.parquet(sorted(files)[0]).schema


def _leaves(kind, path: str) -> Iterator[tuple[str, str]]:
    import pyarrow.types as pt

    if pt.is_struct(kind):
        yield path, "struct"
        for i in range(kind.num_fields):
            yield from _leaves(kind.field(i).type, f"{path}.{kind.field(i).name.lower()}")
    elif pt.is_list(kind) or pt.is_large_list(kind):
        yield path, "list"
        yield from _leaves(kind.value_type, f"{path}.[]")
    elif pt.is_map(kind):
        yield path, "map"
        yield from _leaves(kind.key_type, f"{path}.key")
        yield from _leaves(kind.item_type, f"{path}.value")
    else:
        yield path, str(kind)


def footer_fields(uri: str, filesystem=None) -> dict[str, str]:
    """Type of every column and nested field of a Parquet file, by lower-case path."""
    return dict(x for f in parquet_schema(uri, filesystem) for x in _leaves(f.type, f.name.lower()))


# Footer types that Spark reads as another, wider type.
_READS_AS = {
    "int8": ("int16", "int32", "int64", "float", "double"), "int16": ("int32", "int64", "float", "double"),
    "int32": ("int64", "double"), "float": ("double",), "string": ("large_string",), "large_string": ("string",),
}


def _reads_as(have: str, want: str) -> bool:
    return have == want or want in _READS_AS.get(have, ())


def footer_report(spark: SparkSession, files: DataFrame, reference: str, filesystem=None) -> DataFrame:
    """``(path, missing, extra, retyped)`` per file, against the footer of ``reference``.

    Names are lower-case paths of columns and nested fields; ``retyped`` are those whose type
    does not read as the reference's. ``files`` has a ``path`` column; footers are read by
    ``mapInPandas`` tasks, so many files are checked in parallel and no file content is scanned.
    """
    ref = footer_fields(reference, filesystem)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            missing, extra, retyped = [], [], []
            for p in pdf["path"]:
                got = footer_fields(p, filesystem)
                missing.append(sorted(set(ref) - set(got)))
                extra.append(sorted(set(got) - set(ref)))
                retyped.append(sorted(k for k in ref if k in got and not _reads_as(got[k], ref[k])))
            yield pd.DataFrame({"path": pdf["path"], "missing": missing, "extra": extra,
                                "retyped": retyped})

    return files.select("path").mapInPandas(
        check, "path string, missing array<string>, extra array<string>, retyped array<string>"
    )


class NoFiles(ValueError):
    pass


_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of one column seen with two types in different files."""
    if a == b:
        return a
    ia, ib = _INT_RANK.get(type(a)), _INT_RANK.get(type(b))
    if ia and ib:
        return a if ia >= ib else b
    floating = (T.FloatType, T.DoubleType)
    if (ia or isinstance(a, floating)) and (ib or isinstance(b, floating)):
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widen_fields([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen(a.keyType, b.keyType), widen(a.valueType, b.valueType), True)
    raise SchemaMismatch(f"cannot combine {a.simpleString()} and {b.simpleString()}")


def widen_fields(schemas: Sequence[T.StructType]) -> T.StructType:
    """Union of the fields of several schemas, each at its widest type, in order of appearance."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            key = f.name.lower()
            if key in fields:
                kind = widen(fields[key].dataType, f.dataType)
                fields[key] = T.StructField(fields[key].name, kind, True)
            else:
                fields[key] = T.StructField(f.name, f.dataType, True)
    return T.StructType(list(fields.values()))


#: Between the names in a field's place; parts of nested types have names in brackets.
_SEP = "\x1f"
_ELEMENT, _KEY, _VALUE = "[]", "[key]", "[value]"
# The schema that Spark writes into a footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _spark_kind(kind) -> T.DataType | None:
    """How Spark reads an Arrow type of a footer; None where that must be asked of Spark."""
    import pyarrow as pa
    import pyarrow.types as pt

    plain = {pa.bool_(): T.BooleanType(), pa.int8(): T.ByteType(), pa.int16(): T.ShortType(), pa.int32(): T.IntegerType(),
             pa.int64(): T.LongType(), pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(),
             pa.uint64(): T.DecimalType(20, 0), pa.float32(): T.FloatType(), pa.float64(): T.DoubleType(), pa.string(): T.StringType(),
             pa.large_string(): T.StringType(), pa.binary(): T.BinaryType(), pa.large_binary(): T.BinaryType(), pa.date32(): T.DateType()}
    if kind in plain:
        return plain[kind]
    if pt.is_timestamp(kind):
        return T.TimestampType() if kind.tz else T.TimestampNTZType()
    if pt.is_decimal128(kind):
        return T.DecimalType(kind.precision, kind.scale)
    if pt.is_struct(kind):
        parts = [_spark_kind(kind.field(i).type) for i in range(kind.num_fields)]
        return None if None in parts else T.StructType([T.StructField(kind.field(i).name, p) for i, p in enumerate(parts)])
    if pt.is_list(kind) or pt.is_large_list(kind):
        part = _spark_kind(kind.value_type)
        return None if part is None else T.ArrayType(part)
    if pt.is_map(kind):
        key, value = _spark_kind(kind.key_type), _spark_kind(kind.item_type)
        return None if key is None or value is None else T.MapType(key, value)
    return None


def footer_schema(uri: str, filesystem=None) -> list[tuple[str, T.DataType | None]]:
    """The columns of a Parquet file as Spark reads them, from its footer alone: by the schema that
    Spark wrote there, else by the Parquet types; a type of None must be asked of Spark."""
    arrow = parquet_schema(uri, filesystem)
    written = (arrow.metadata or {}).get(_SPARK_SCHEMA)
    if written is not None:
        return [(f.name, f.dataType) for f in T._parse_datatype_json_string(written.decode()).fields]
    return [(f.name, _spark_kind(f.type)) for f in arrow]


def _own_schema(uri: str, filesystem) -> T.StructType:
    """The schema of a file that Spark cannot read itself."""
    fields = footer_schema(uri, filesystem)
    unknown = [name for name, kind in fields if kind is None]
    if unknown:
        raise SchemaMismatch(f"{uri}: columns {unknown} have types that only Spark's own reader knows")
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def _places(kind: T.DataType | None, place: str, name: str) -> Iterator[tuple[str, str, str]]:
    """(place, name, type) of a column and of everything inside it, in order."""
    if isinstance(kind, T.StructType):
        yield place, name, "struct"
        for f in kind.fields:
            yield from _places(f.dataType, f"{place}{_SEP}{f.name.lower()}", f.name)
    elif isinstance(kind, T.ArrayType):
        yield place, name, "array"
        yield from _places(kind.elementType, f"{place}{_SEP}{_ELEMENT}", _ELEMENT)
    elif isinstance(kind, T.MapType):
        yield place, name, "map"
        yield from _places(kind.keyType, f"{place}{_SEP}{_KEY}", _KEY)
        yield from _places(kind.valueType, f"{place}{_SEP}{_VALUE}", _VALUE)
    else:
        yield place, name, "?" if kind is None else kind.simpleString()


def footer_places(inventory: DataFrame, filesystem=None) -> DataFrame:
    """``(path, pos, place, name, kind)``: a row per file, column and nested field, read from footers
    in parallel tasks."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                rows = [x for name, kind in footer_schema(p, filesystem) for x in _places(kind, name.lower(), name)]
                yield pd.DataFrame({"path": [p] * len(rows), "pos": range(len(rows)), "place": [x[0] for x in rows],
                                    "name": [x[1] for x in rows], "kind": [x[2] for x in rows]})

    return inventory.select("path").mapInPandas(read, "path string, pos int, place string, name string, kind string")


def merge_places(places: DataFrame) -> DataFrame:
    """``(place, kinds, path, pos, name)``: every place of any file once, with all types it has and
    where it comes first (by path, then position). Does not depend on the order of rows; partial
    sets in tasks, one row a place after the shuffle."""
    first = F.min(F.struct("path", "pos", "name"))
    return places.groupBy("place").agg(F.sort_array(F.collect_set("kind")).alias("kinds"), first.alias("first")).select(
        "place", "kinds", "first.*")


def _merged_type(spark: SparkSession, tree: dict, place: str) -> T.DataType:
    row, inside = tree[place]
    shapes = {k for k in row["kinds"] if k in ("struct", "array", "map")}
    if shapes and len(row["kinds"]) > 1:
        raise SchemaMismatch(f"cannot combine {' and '.join(row['kinds'])} in {place.replace(_SEP, '.')}")
    part = lambda name: _merged_type(spark, tree, f"{place}{_SEP}{name}")
    if shapes == {"struct"}:
        return T.StructType([T.StructField(tree[p][0]["name"], _merged_type(spark, tree, p), True) for p in inside])
    if shapes == {"array"}:
        return T.ArrayType(part(_ELEMENT), True)
    if shapes == {"map"}:
        return T.MapType(part(_KEY), part(_VALUE), True)
    kinds = [T.DataType.fromDDL(k) if k != "?" else _asked(spark, row) for k in row["kinds"]]
    out = kinds[0]
    for k in kinds[1:]:
        out = widen(out, k)
    return out


def _asked(spark: SparkSession, row) -> T.DataType:
    """The type Spark gives to a place whose Parquet type has no name here, in the file that has it first."""
    kind: T.DataType = spark.read.parquet(row["path"]).schema
    for name in row["place"].split(_SEP):
        if isinstance(kind, T.StructType):
            kind = next(f.dataType for f in kind.fields if f.name.lower() == name)
        elif isinstance(kind, T.ArrayType):
            kind = kind.elementType
        else:
            kind = kind.keyType if name == _KEY else kind.valueType
    return kind


def _schema_of(spark: SparkSession, merged: list) -> tuple[T.StructType, dict]:
    """The schema that the rows of ``merge_places`` describe, and its type by place."""
    tree: dict[str, tuple] = {}
    top = []
    for row in sorted(merged, key=lambda r: (r["path"], r["pos"])):
        tree[row["place"]] = (row, [])
    for place, (row, _) in tree.items():
        above = place.rpartition(_SEP)[0]
        (tree[above][1] if above else top).append(place)
    schema = T.StructType([T.StructField(tree[p][0]["name"], _merged_type(spark, tree, p), True) for p in top])
    return schema, {p: k for f in schema.fields for p, _, k in _places(f.dataType, f.name.lower(), f.name)}


def merged_schema(spark: SparkSession, inventory: DataFrame, filesystem=None) -> T.StructType:
    """Union of the files' columns, each at the widest type it has in any file, in order of their
    first appearance by path. One job, whatever the number of different footers; as many rows as
    there are columns and nested fields reach the driver."""
    return _schema_of(spark, merge_places(footer_places(inventory, filesystem)).collect())[0]


def _cast_nested(col, have: T.DataType, want: T.DataType):
    """A value of type ``have`` as ``want``, fields matched by name, missing ones null."""
    if have == want:
        return col
    if isinstance(have, T.StructType):
        kinds = {f.name.lower(): f for f in have.fields}
        parts = [
            (_cast_nested(col.getField(kinds[f.name.lower()].name), kinds[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: _cast_nested(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType):
        return F.transform_values(F.transform_keys(col, lambda k, v: _cast_nested(k, have.keyType, want.keyType)),
                                  lambda k, v: _cast_nested(v, have.valueType, want.valueType))
    return col.cast(want)


def _narrowed(kind: T.DataType, place: str, kept: dict[str, str]) -> T.DataType:
    """A type with the places of ``kept`` at the types given there."""
    if place in kept:
        return T.DataType.fromDDL(kept[place])
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _narrowed(f.dataType, f"{place}{_SEP}{f.name.lower()}", kept), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_narrowed(kind.elementType, f"{place}{_SEP}{_ELEMENT}", kept), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_narrowed(kind.keyType, f"{place}{_SEP}{_KEY}", kept), _narrowed(kind.valueType, f"{place}{_SEP}{_VALUE}", kept), True)
    return kind


def _read_merged(spark: SparkSession, paths: list[str], inventory: DataFrame, filesystem) -> DataFrame:
    """All files at the merged schema. Spark's reader widens types itself, but gives no bigint as a
    double: files that have bigints where others have fractions are scanned by themselves (by name,
    one scan per set of such columns), cast and united with the scan of all others."""
    places = footer_places(inventory, filesystem).persist()
    try:
        schema, kinds = _schema_of(spark, merge_places(places).collect())
        wide = [p for p, k in kinds.items() if k == type_name(T.DoubleType())]
        odd = places.where((F.col("kind") == type_name(T.LongType())) & F.col("place").isin(wide)) if wide else places.limit(0)
        sets = odd.groupBy("path").agg(F.sort_array(F.collect_set("place")).alias("places"))
        groups: dict[tuple, list[str]] = {}
        for r in sets.collect():  # the odd files only
            groups.setdefault(tuple(r["places"]), []).append(r["path"])
        if not groups:
            return spark.read.schema(schema).parquet(*paths)
        rest = [r["path"] for r in inventory.select("path").join(sets.select("path"), "path", "left_anti").collect()]
    finally:
        places.unpersist()
    out = spark.read.schema(schema).parquet(*rest) if rest else None
    for narrow, files in sorted(groups.items()):
        kept = dict.fromkeys(narrow, type_name(T.LongType()))
        own = T.StructType([T.StructField(f.name, _narrowed(f.dataType, f.name.lower(), kept), True) for f in schema.fields])
        part = spark.read.schema(own).parquet(*files)
        part = part.select(*[_cast_nested(F.col(f"`{f.name}`"), own[f.name].dataType, f.dataType).alias(f.name) for f in schema.fields])
        out = part if out is None else out.unionByName(part)
    return out


def read_dataset(spark: SparkSession, files: str | Sequence[str], mode: str = "strict",
                 schema: T.StructType | None = None, filesystem=None,
                 inventory: DataFrame | None = None, through=None) -> DataFrame:
    """One DataFrame over all files of a dataset (file order is neither kept nor needed).

    ``files`` is a list of paths or a glob such as ``<dir>/*.parquet``; with a glob the
    file list stays a DataFrame (listed by Spark; ``inventory``, when the caller has listed
    the files already) and does not pass through the driver. The exception is ``merge`` where
    bigint and double meet in one column: those files are then named one by one. ``through`` (with a
    glob): the files are listed and read through a remote source's file system.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if isinstance(files, str):
        inventory = (file_inventory(spark, files, through=through) if inventory is None else inventory).select("path")
        paths: list[str] = [files]
    else:
        paths = sorted(files)
        inventory = spark.createDataFrame([(f,) for f in paths], "path string")
    head = [r["path"] for r in inventory.orderBy("path").take(2)]
    if not head:
        raise NoFiles(f"no Parquet files in {files}")
    if schema is None and mode == "merge" and through is not None:
        return read_remote(spark, paths[0], merged_schema(spark, inventory, through), through)
    if schema is None and mode == "merge":
        return _read_merged(spark, paths, inventory, filesystem)
    first = schema or (infer_schema(spark, head) if through is None else _own_schema(head[0], through))
    if mode == "strict" and len(head) > 1:
        others = inventory.where(F.col("path") != head[0])
        report = footer_report(spark, others, head[0], filesystem)
        bad = report.where((F.size("missing") > 0) | (F.size("retyped") > 0)).take(5)
        if bad:
            desc = "; ".join(
                f"{r['path']}" + (f" lacks {list(r['missing'])}" if r["missing"] else "")
                + (f" has other types in {list(r['retyped'])}" if r["retyped"] else "") for r in bad)
            raise SchemaMismatch(f"files disagree with {head[0]}: {desc}")
    return spark.read.schema(first).parquet(*paths) if through is None else read_remote(spark, paths[0], first, through)
