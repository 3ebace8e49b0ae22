"""File checksums as a Spark job, and their comparison with a release manifest.

Every file, whatever its size, is streamed in chunks by a ``mapInPandas`` task (see
``sources.files`` for how it is opened). Files are listed once and dealt over tasks by range
of path, about evenly; a task's memory is one chunk.

Hashes can be remembered: a file whose path, length and modification time are as they were when it
was hashed is not read again. A file changed so shortly before it was hashed that a later change
could carry the same time is never remembered (``SETTLED``).
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.sources.files import open_stream, require_reader
from relsync.sources.inventory import file_inventory

CHUNK = 8 << 20
#: Seconds that a file must have been left alone before its hash for the hash to be remembered.
SETTLED = 2
MEMORY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("sha1", T.StringType(), False),
        T.StructField("hashed_at", T.TimestampType(), False),
    ]
)
#: Most tasks that one hashing job is dealt over.
MAX_TASKS = 10_000

STATUS_OK = "ok"
STATUS_MISMATCH = "mismatch"
STATUS_NOT_IN_MANIFEST = "not_in_manifest"
STATUS_MISSING = "missing_file"


class IntegrityError(ValueError):
    """A file of the release does not agree with the manifest."""


class ChecksumMismatch(IntegrityError):
    pass


class NotInManifest(IntegrityError, KeyError):
    def __str__(self) -> str:  # KeyError would quote the message
        return ValueError.__str__(self)


class MissingFile(IntegrityError, FileNotFoundError):
    pass


_ERROR_OF = {STATUS_MISMATCH: ChecksumMismatch, STATUS_NOT_IN_MANIFEST: NotInManifest,
             STATUS_MISSING: MissingFile}


def hash_files(spark: SparkSession, pattern: str, glob_filter: str | None = None,
               filesystem=None, inventory: DataFrame | None = None) -> DataFrame:
    """``(path, length, sha1)`` for every file matching ``pattern``.

    ``inventory``: the files, when the caller has listed them already (``file_inventory``).
    """
    require_reader(pattern, filesystem)
    files = file_inventory(spark, pattern, glob_filter) if inventory is None else inventory
    n = files.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                h = hashlib.sha1()
                with open_stream(p, filesystem) as f:
                    while block := f.read(CHUNK):
                        h.update(block)
                out.append(h.hexdigest())
            yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "sha1": out})

    dealt = files.select("path", "length").repartitionByRange(max(1, min(n, MAX_TASKS)), "path")
    return dealt.mapInPandas(run, "path string, length bigint, sha1 string")


def known_hashes(inventory: DataFrame, memory: DataFrame) -> DataFrame:
    """``(path, length, modificationTime, sha1)`` of every file of ``inventory``; sha1 is null where the
    file must be hashed: it is not remembered, or its length or time is another one.

    ``memory`` (MEMORY_SCHEMA) may hold a path many times; what was hashed last counts, also if an
    older entry would fit. One partial aggregation and one join on the path.
    """
    last = memory.groupBy(F.col("path").alias("__path")).agg(
        F.max_by(F.struct("length", "modificationTime", "sha1"), F.struct("hashed_at", "modificationTime", "length", "sha1")).alias("__was"))
    same = (F.col("length") == F.col("__was.length")) & (F.col("modificationTime") == F.col("__was.modificationTime"))
    return inventory.join(last, F.col("path") == F.col("__path"), "left").select(
        "path", "length", "modificationTime", F.when(same, F.col("__was.sha1")).alias("sha1"))


def hash_changed(spark: SparkSession, pattern: str, memory: DataFrame, filesystem=None,
                 inventory: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The hashes ``(path, length, sha1)`` of every file, reading only those ``memory`` does not know;
    and those of the files that were read (MEMORY_SCHEMA; remember what is ``settled``). The second is
    persisted, so that files are read once for both: the caller unpersists it when done, else a later
    call over the same folder would find the old rows."""
    files = file_inventory(spark, pattern) if inventory is None else inventory
    decided = known_hashes(files, memory)
    unknown = decided.where("sha1 IS NULL").drop("sha1")
    started = F.current_timestamp()
    fresh = hash_files(spark, pattern, filesystem=filesystem, inventory=unknown).join(
        unknown.select(F.col("path").alias("__path"), "modificationTime"), F.col("path") == F.col("__path")).select(
        "path", "length", "modificationTime", "sha1", started.alias("hashed_at")).persist()
    known = decided.where("sha1 IS NOT NULL").select("path", "length", "sha1")
    return known.unionByName(fresh.select("path", "length", "sha1")), fresh


def settled(fresh: DataFrame) -> DataFrame:
    """Hashes that may be remembered: of files left alone for SETTLED seconds before."""
    return fresh.where(F.col("modificationTime") < F.col("hashed_at") - F.make_dt_interval(secs=F.lit(SETTLED)))


def compare_hashes(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(path, status, expected_sha1, actual_sha1)`` from ``files(path, sha1)`` and
    ``manifest(path, sha1)``, both keyed by the manifest's relative path.

    status: ok, mismatch, not_in_manifest (file without entry), missing_file (entry
    without file). One full outer join on the path; paths are unique on both sides.
    """
    f = files.select(F.col("path").alias("rel"), F.col("sha1").alias("actual_sha1"))
    m = manifest.select(F.col("path").alias("mpath"), F.col("sha1").alias("expected_sha1"))
    joined = f.join(m, f["rel"] == m["mpath"], "full_outer")
    status = (
        F.when(F.col("mpath").isNull(), F.lit(STATUS_NOT_IN_MANIFEST))
        .when(F.col("rel").isNull(), F.lit(STATUS_MISSING))
        .when(F.col("actual_sha1") == F.col("expected_sha1"), F.lit(STATUS_OK))
        .otherwise(F.lit(STATUS_MISMATCH))
    )
    return joined.select(
        F.coalesce("rel", "mpath").alias("path"),
        status.alias("status"),
        "expected_sha1",
        "actual_sha1",
    )


def verify_files(hashed: DataFrame, manifest: DataFrame, relative_prefix: str,
                 suffix: str | None = None) -> DataFrame:
    """Verification report for the files of one dataset directory.

    ``hashed`` holds the dataset's files (absolute ``path``, ``sha1``); their manifest key
    is ``relative_prefix`` + file name (data files sit directly in the dataset directory).
    Only manifest entries directly under the prefix take part, and with ``suffix`` only
    those ending with it (so a listed ``_SUCCESS`` marker is not a missing data file).
    """
    files = hashed.select(
        F.concat(F.lit(relative_prefix), F.substring_index("path", "/", -1)).alias("path"),
        "sha1",
    )
    name = F.substring(F.col("path"), len(relative_prefix) + 1, 1 << 30)
    cond = F.col("path").startswith(relative_prefix) & ~name.contains("/")
    if suffix:
        cond = cond & F.col("path").endswith(suffix)
    return compare_hashes(files, manifest.where(cond))


def require_verified(report: DataFrame, sample: int = 5) -> None:
    """Raise :class:`IntegrityError` naming the first failures of a verification report."""
    bad = report.where(F.col("status") != STATUS_OK).orderBy("status", "path").take(sample)
    if bad:
        desc = "; ".join(f"{r['path']}: {r['status']}" for r in bad)
        raise _ERROR_OF[bad[0]["status"]](f"file verification failed: {desc}")
