"""File inventory of a release tree: versions, datasets, data files.

Listing uses the ``binaryFile`` source without selecting ``content``, so only file
metadata is read; Spark lists large trees with a parallel listing job.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.functions.versions import is_version, newest_first, version_major, version_minor
from relsync.sources.remote import remote_inventory
from relsync.spec import Source

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
    ]
)


def _path_missing(e: AnalysisException) -> bool:
    text = str(e)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def binary_files(spark: SparkSession, pattern: str,
                 glob_filter: str | None = None) -> DataFrame | None:
    """The ``binaryFile`` relation of a path or glob (listed once), None when nothing matches."""
    reader = spark.read.format("binaryFile")
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    try:
        return reader.load(pattern)
    except AnalysisException as e:
        if _path_missing(e):
            return None
        raise


def file_inventory(spark: SparkSession, pattern: str, glob_filter: str | None = None, through=None) -> DataFrame:
    """``(path, length, modificationTime)`` of the files matching a path or glob.

    A pattern matching nothing gives an empty DataFrame instead of an error. ``through``: list a
    remote source's file system instead of Hadoop's.
    """
    if through is not None:
        return remote_inventory(spark, pattern, through)
    df = binary_files(spark, pattern, glob_filter)
    if df is None:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return df.select("path", "length", "modificationTime")


def list_versions(spark: SparkSession, source: Source) -> DataFrame:
    """``(version, major, minor)`` of every release with a manifest, newest first."""
    inv = file_inventory(spark, source.manifest_glob(), through=source.through)
    name = F.regexp_extract("path", source.version_regex(), 1)
    return (
        inv.select(name.alias("version"))
        .where(is_version(F.col("version")))
        .distinct()
        .select("version", version_major(F.col("version")).alias("major"),
                version_minor(F.col("version")).alias("minor"))
        .orderBy(*newest_first(F.col("version")))
    )


def latest_version(spark: SparkSession, source: Source) -> str:
    """Newest release name; raises when there is none."""
    rows = list_versions(spark, source).select("version").take(1)
    if not rows:
        raise LookupError(f"no release matching YY.MM with a manifest under {source.root}")
    return rows[0]["version"]


def dataset_of(path: Column) -> Column:
    """Name of the directory holding a file: the dataset of a data file path."""
    return F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)


def list_datasets(spark: SparkSession, source: Source, version: str) -> DataFrame:
    """``(dataset)``: directories of the release's Parquet root holding Parquet files, sorted."""
    inv = file_inventory(spark, f"{source.parquet_root(version)}/*/*.parquet", through=source.through)
    return (
        inv.select(dataset_of(F.col("path")).alias("dataset"))
        .distinct()
        .orderBy("dataset")
    )


def list_data_files(spark: SparkSession, source: Source, version: str, dataset: str) -> DataFrame:
    """``(path, length, modificationTime)`` of ``*.parquet`` directly in the dataset directory."""
    return file_inventory(spark, f"{source.dataset_dir(version, dataset)}/*.parquet", through=source.through).orderBy("path")


def suggest_specs(datasets: DataFrame, default_key: str = "id") -> DataFrame:
    """``(dataset, final_table_name, primary_key)``: a starting spec for each dataset."""
    return datasets.select(
        F.col("dataset"),
        F.regexp_replace("dataset", "-", "_").alias("final_table_name"),
        F.lit(default_key).alias("primary_key"),
    )
