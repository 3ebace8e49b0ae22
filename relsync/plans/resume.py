"""Loads that go on where a killed one stopped, by file.

The projected rows of a dataset's files are written in batches of files below a work folder; a batch
counts once its record, the files it holds with their length and time, was written after its rows. A
load that starts again finds the files of all records, by a join with the files as they are now, and
reads only the others. Files that changed since make their batch void: it is read again. When all
files are held, the rows of all batches are the dataset's rows::

    <work>/rows/<batch>/*.parquet     projected rows
    <work>/done/<batch>/*.parquet     path, length, modificationTime of the batch's files

This writes every row once more than a plain load. It pays where reading and projecting a dataset
takes so long that losing half of it matters.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.sources.files import locate

#: Files read and written as one batch.
BATCH_FILES = 1000

_RECORD = "path string, length long, modificationTime timestamp"


def batch_records(spark: SparkSession, work: str) -> DataFrame:
    """``(batch, path, length, modificationTime)`` of the files of every committed batch."""
    try:
        found = spark.read.schema(_RECORD).parquet(f"{work}/done/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"batch string, {_RECORD}")
    return found.select(F.regexp_extract(F.col("_metadata.file_path"), "/done/([^/]+)/", 1).alias("batch"), "*")


def usable_batches(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """``(batch)``: committed batches whose files are all there as they were when they were read."""
    now = inventory.select(F.col("path").alias("__path"), F.col("length").alias("__length"), F.col("modificationTime").alias("__time"))
    same = (F.col("path") == F.col("__path")) & (F.col("length") == F.col("__length")) & (F.col("modificationTime") == F.col("__time"))
    return records.join(now, same, "left").groupBy("batch").agg(F.bool_and(F.col("__path").isNotNull()).alias("ok")).where("ok").select("batch")


def files_to_read(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """The rows of ``inventory`` that no usable batch holds."""
    held = records.join(usable_batches(records, inventory), "batch").select("path").distinct()
    return inventory.join(held, "path", "left_anti")


def resumable_rows(spark: SparkSession, work: str, inventory: DataFrame, read: Callable[[Sequence[str]], DataFrame],
                   batch_files: int = BATCH_FILES) -> DataFrame:
    """The rows that ``read`` gives for all files of ``inventory``, read in batches of files that a
    killed call leaves behind for the next one. ``read`` must give equal columns for any files."""
    records = batch_records(spark, work)
    # a file's path is a line on the driver, as wherever files are named to a reader
    todo = [tuple(r) for r in files_to_read(records, inventory).select("path", "length", "modificationTime").orderBy("path").collect()]
    kept = [r["batch"] for r in usable_batches(records, inventory).collect()]
    for at in range(0, len(todo), batch_files):
        some, batch = todo[at:at + batch_files], uuid.uuid4().hex
        read([p for p, _, _ in some]).write.mode("errorifexists").parquet(f"{work}/rows/{batch}")
        # the commit of the batch
        spark.createDataFrame(some, _RECORD).coalesce(1).write.mode("errorifexists").parquet(f"{work}/done/{batch}")
        kept.append(batch)
    if not kept:
        return read([])
    schema = spark.read.parquet(f"{work}/rows/{kept[0]}").schema
    return spark.read.schema(schema).parquet(*[f"{work}/rows/{b}" for b in sorted(kept)])


def forget(work: str) -> None:
    """Remove a work folder after its rows were published."""
    from pyarrow import fs

    found, at = locate(work)
    if found.get_file_info(at).type == fs.FileType.Directory:
        found.delete_dir(at)
