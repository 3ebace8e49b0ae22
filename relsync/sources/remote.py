"""Releases in file systems that Spark itself cannot list or read (ftp, http, anonymous access).

With ``Source(..., filesystem=fs, remote=True)`` every step goes through the given
``pyarrow.fs.FileSystem``: listing (one call per folder, on the driver, where Spark would list too),
manifests, footers and checksums, and the data, which the format ``relsync_parquet`` reads in tasks of
its own: one partition per file, or per bounded stretch of row groups of a large one, and only the
columns of the schema it is given. The file system must be picklable, since tasks open files with it.
"""

from __future__ import annotations

import base64
import datetime as dt
import fnmatch
from dataclasses import dataclass
from typing import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from relsync.sources.files import locate, split_uri

FORMAT = "relsync_parquet"
#: Bytes of a file's row groups that one partition reads (or one row group, if larger).
PARTITION_BYTES = 128 << 20


def glob_files(pattern: str, filesystem) -> list[tuple[str, int, dt.datetime]]:
    """(uri, length, modification time) of the files that match a pattern, sorted. ``*``, ``?`` and
    ``[..]`` stand within one name; only folders that can match are listed. A folder that does not
    exist holds nothing."""
    from pyarrow import fs

    scheme, authority, path = split_uri(pattern)
    prefix = pattern[: len(pattern) - len(path)]
    names = [n for n in path.split("/") if n]
    level = [path[: len(path) - len(path.lstrip("/"))]]
    for depth, name in enumerate(names):
        last, wild, found = depth == len(names) - 1, any(c in name for c in "*?["), []
        for folder in level:
            at = f"{folder.rstrip('/')}/{name}" if folder else name
            if not wild and not last:
                found.append(at)
                continue
            where = locate(prefix + (folder or "/"), filesystem)[1]
            listed = filesystem.get_file_info(fs.FileSelector(where, allow_not_found=True)) if wild else [filesystem.get_file_info(locate(prefix + at, filesystem)[1])]
            for f in listed:
                child = f"{folder.rstrip('/')}/{f.base_name}" if folder else f.base_name
                if fnmatch.fnmatchcase(f.base_name, name) and f.type == (fs.FileType.File if last else fs.FileType.Directory):
                    found.append((prefix + child, f.size or 0, f.mtime or dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) if last else child)
        level = found
    return sorted(level)


def remote_inventory(spark: SparkSession, pattern: str, filesystem) -> DataFrame:
    """``(path, length, modificationTime)`` of the files matching a pattern."""
    rows = [(uri, size, time) for uri, size, time in glob_files(pattern, filesystem)]
    return spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")


def remote_lines(spark: SparkSession, path: str, filesystem) -> DataFrame:
    """``(value, pos)``: the lines of a text file, streamed by one task."""
    import pandas as pd

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for pdf in batches:
            for p in pdf["path"]:
                found, at = locate(p, filesystem)
                with found.open_input_stream(at) as raw:
                    lines, first = [], 0
                    for line in io.TextIOWrapper(raw, encoding="utf-8", newline="\n"):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == 10_000:
                            yield pd.DataFrame({"value": lines, "pos": range(first, first + len(lines))})
                            first, lines = first + len(lines), []
                    yield pd.DataFrame({"value": lines, "pos": range(first, first + len(lines))})

    return spark.createDataFrame([(path,)], "path string").mapInPandas(read, "value string, pos long")


def fit(array, kind):
    """An Arrow array as another type: struct fields by name (case aside), missing ones null."""
    import pyarrow as pa
    import pyarrow.types as pt

    if array.type == kind:
        return array
    if pt.is_struct(kind) and pt.is_struct(array.type):
        have = {array.type.field(i).name.lower(): i for i in range(array.type.num_fields)}
        parts = [fit(array.field(have[f.name.lower()]), f.type) if f.name.lower() in have else pa.nulls(len(array), f.type) for f in kind]
        return pa.StructArray.from_arrays(parts, fields=list(kind), mask=array.is_null())
    if pt.is_list(kind) and (pt.is_list(array.type) or pt.is_large_list(array.type)):
        array = array.cast(pa.list_(array.type.value_field))
        return pa.ListArray.from_arrays(array.offsets, fit(array.values, kind.value_type), type=kind, mask=array.is_null())
    return array.cast(kind)


@dataclass
class RowGroups(InputPartition):
    file: str
    groups: tuple[int, ...]


class _Reader(DataSourceReader):
    def __init__(self, pattern: str, schema: T.StructType, filesystem):
        self.pattern, self.schema, self.filesystem = pattern, schema, filesystem

    def _open(self, uri: str):
        import pyarrow.parquet as pq

        found, at = locate(uri, self.filesystem)
        return pq.ParquetFile(found.open_input_file(at))

    def partitions(self):
        out = []
        for uri, length, _ in glob_files(self.pattern, self.filesystem):
            if length <= PARTITION_BYTES:
                out.append(RowGroups(uri, ()))  # all of them, not looked at here
                continue
            meta, some, held = self._open(uri).metadata, [], 0
            for g in range(meta.num_row_groups):
                size = meta.row_group(g).total_byte_size
                if some and held + size > PARTITION_BYTES:
                    out.append(RowGroups(uri, tuple(some)))
                    some, held = [], 0
                some.append(g)
                held += size
            out.append(RowGroups(uri, tuple(some)))
        return out or [RowGroups("", ())]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.file:
            return
        want = to_arrow_schema(self.schema)
        data = self._open(partition.file)
        have = {n.lower(): n for n in data.schema_arrow.names}
        read = [have[f.name.lower()] for f in want if f.name.lower() in have]
        for batch in data.iter_batches(batch_size=8192, columns=read, row_groups=list(partition.groups) or None):
            columns = [fit(batch.column(have[f.name.lower()]), f.type) if f.name.lower() in have else pa.nulls(batch.num_rows, f.type) for f in want]
            if not columns:
                continue
            yield pa.RecordBatch.from_arrays(columns, schema=want)


class RemoteParquet(DataSource):
    """``spark.read.format("relsync_parquet").schema(...)`` with options ``path`` (a pattern) and
    ``filesystem`` (see ``packed``). A schema is needed: it decides which columns are read."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        raise ValueError("give a schema")

    def reader(self, schema):
        return _Reader(self.options["path"], schema, cloudpickle.loads(base64.b64decode(self.options["filesystem"])))


def packed(filesystem) -> str:
    """A file system as an option's text."""
    return base64.b64encode(cloudpickle.dumps(filesystem)).decode()


def read_remote(spark: SparkSession, pattern: str, schema: T.StructType, filesystem) -> DataFrame:
    """The rows of all files that match a pattern, at a schema; columns that a file lacks are null."""
    spark.dataSource.register(RemoteParquet)
    return spark.read.format(FORMAT).schema(schema).option("filesystem", packed(filesystem)).load(pattern)
