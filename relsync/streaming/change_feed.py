"""A table's changes as a stream: insert, update and delete rows per published generation.

A sink with a ``ChangeFeed`` writes, beside every generation, the rows that it changes, and lists the
generation once it is published. The streaming source ``relsync_changes`` reads them: its offset is
the number of generations listed so far, so a query that stops and starts again goes on at the
next generation, and a replay by key of all rows from the start gives the current table. Files::

    <root>/<table>/rows/<generation>/*.parquet      op, then the generation's columns
    <root>/<table>/log/<number>_<generation>        one empty file per published generation, from 1

The rows are written before the generation is published and its log file after; a process that ends
in between leaves that to the next publish (``CatalogSink`` lists the current generation first).
One process at a time publishes a table, so numbers have no gaps.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from relsync.sources.files import locate

FORMAT = "relsync_changes"
#: Columns of the source before those of the table.
FEED_FIELDS = [T.StructField("seq", T.LongType()), T.StructField("generation", T.StringType()), T.StructField("op", T.StringType())]


def listed(path: str, filesystem=None) -> list[tuple[int, str]]:
    """(number, generation) of every published generation of one table's feed, in order."""
    from pyarrow import fs

    found, base = locate(path, filesystem)
    selector = fs.FileSelector(f"{base}/log", allow_not_found=True)
    names = [f.base_name for f in found.get_file_info(selector) if f.type == fs.FileType.File]
    return sorted((int(n.split("_", 1)[0]), n.split("_", 1)[1]) for n in names if n[:1].isdigit() and "_" in n)


def files_of(path: str, generation: str, filesystem=None) -> list[str]:
    """The data files of one generation's changes, as paths of the file system."""
    from pyarrow import fs

    found, base = locate(path, filesystem)
    selector = fs.FileSelector(f"{base}/rows/{generation}", allow_not_found=True)
    return sorted(f.path for f in found.get_file_info(selector) if f.type == fs.FileType.File and f.base_name.endswith(".parquet"))


class ChangeFeed:
    """Where a sink writes its tables' changes: a folder that all machines share.

    ``filesystem`` opens it where the scheme alone does not tell how (see ``sources.files``).
    """

    def __init__(self, root: str, filesystem=None):
        self.root = root.rstrip("/")
        self.filesystem = filesystem

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def listed(self, table: str) -> list[tuple[int, str]]:
        return listed(self.path(table), self.filesystem)

    def write(self, table: str, generation: str, changes: DataFrame) -> None:
        """The rows that ``generation`` changes; not visible to readers before ``publish``."""
        changes.write.mode("overwrite").parquet(f"{self.path(table)}/rows/{generation}")

    def publish(self, table: str, generation: str) -> int | None:
        """List a published generation, once; its number. None for one that has no rows written
        here (a table from before the feed): a reader then starts with the generations after it."""
        have = self.listed(table)
        for number, name in have:
            if name == generation:
                return number
        found, base = locate(self.path(table), self.filesystem)
        from pyarrow import fs

        if found.get_file_info(f"{base}/rows/{generation}/_SUCCESS").type != fs.FileType.File:
            return None
        number = have[-1][0] + 1 if have else 1
        found.create_dir(f"{base}/log", recursive=True)
        with found.open_output_stream(f"{base}/log/{number:012d}_{generation}"):
            pass
        return number

    def discard(self, table: str, generation: str) -> None:
        """Remove the rows of a generation that is not published after all."""
        from pyarrow import fs

        if generation in {name for _, name in self.listed(table)}:
            return
        found, base = locate(self.path(table), self.filesystem)
        folder = f"{base}/rows/{generation}"
        if found.get_file_info(folder).type == fs.FileType.Directory:
            found.delete_dir(folder)


@dataclass
class ChangedFile(InputPartition):
    seq: int
    generation: str
    file: str


class _Reading:
    """What the batch and the streaming reader share: files of generations, and their rows."""

    def __init__(self, path: str, schema: T.StructType, filesystem=None):
        self.path, self.schema, self.filesystem = path, schema, filesystem

    def between(self, after: int, upto: int) -> list[ChangedFile]:
        return [ChangedFile(seq, name, f) for seq, name in listed(self.path, self.filesystem) if after < seq <= upto
                for f in files_of(self.path, name, self.filesystem)]

    def rows(self, part: ChangedFile) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        found, _ = locate(self.path, self.filesystem)
        with found.open_input_file(part.file) as handle:
            data = pq.ParquetFile(handle)
            have = {n.lower(): n for n in data.schema_arrow.names}
            read = [have[f.name.lower()] for f in want if f.name.lower() in have]
            for batch in data.iter_batches(batch_size=8192, columns=read):
                n = batch.num_rows
                columns = []
                for f in want:
                    if f.name == "seq":
                        columns.append(pa.array([part.seq] * n, pa.int64()))
                    elif f.name == "generation":
                        columns.append(pa.array([part.generation] * n, pa.string()))
                    elif f.name.lower() in have:
                        columns.append(batch.column(have[f.name.lower()]).cast(f.type))
                    else:  # a column that the table got later
                        columns.append(pa.nulls(n, f.type))
                yield pa.RecordBatch.from_arrays(columns, schema=want)


class _BatchReader(_Reading, DataSourceReader):
    def __init__(self, path, schema, after: int, upto: int | None):
        super().__init__(path, schema)
        self.after, self.upto = after, upto

    def partitions(self):
        last = self.upto if self.upto is not None else max((s for s, _ in listed(self.path)), default=0)
        return self.between(self.after, last) or [ChangedFile(0, "", "")]

    def read(self, partition):
        return self.rows(partition) if partition.file else iter(())


class _StreamReader(_Reading, DataSourceStreamReader):
    """Offsets are ``{"generations": n}``: the number of the last generation taken."""

    def __init__(self, path, schema, after: int):
        super().__init__(path, schema)
        self.after = after

    def initialOffset(self):
        return {"generations": self.after}

    def latestOffset(self):
        return {"generations": max((s for s, _ in listed(self.path)), default=self.after)}

    def partitions(self, start, end):
        return self.between(start["generations"], end["generations"]) or [ChangedFile(0, "", "")]

    def read(self, partition):
        return self.rows(partition) if partition.file else iter(())

    def commit(self, end):
        pass


class ChangeFeedSource(DataSource):
    """``spark.read`` / ``spark.readStream.format("relsync_changes").load(<root>/<table>)``.

    Options: ``after`` (generations passed over, 0) and, in batch, ``upto`` (last generation read).
    Columns: seq, generation, op, then the table's, of the newest generation unless a schema is given.
    """

    @classmethod
    def name(cls):
        return FORMAT

    def _path(self) -> str:
        return self.options["path"].rstrip("/")

    def schema(self):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        path = self._path()
        for _, generation in reversed(listed(path)):
            for file in files_of(path, generation):
                found, _ = locate(path)
                with found.open_input_file(file) as handle:
                    fields = from_arrow_schema(pq.read_schema(handle)).fields
                return T.StructType(FEED_FIELDS + [T.StructField(f.name, f.dataType) for f in fields if f.name != "op"])
        raise ValueError(f"no published generation in {path}; give a schema")

    def reader(self, schema):
        upto = self.options.get("upto")
        return _BatchReader(self._path(), schema, int(self.options.get("after", 0)), int(upto) if upto is not None else None)

    def streamReader(self, schema):
        return _StreamReader(self._path(), schema, int(self.options.get("after", 0)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(ChangeFeedSource)


def apply_changes(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` after ``changes`` (op and columns, at most one a key): what a reader of the feed holds
    after one generation."""
    kept = rows.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.where("op <> 'delete'").drop("op"), allowMissingColumns=True)
