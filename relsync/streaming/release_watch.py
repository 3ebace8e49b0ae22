"""Watch a release root and load each newly published release.

A release is published when its manifest checksum file appears. The file stream source
remembers in its checkpoint which ``.sha1`` files it has seen; of the releases that appeared
since the last batch the newest is loaded, and never one older than what the ledger says a
table holds. A batch in which a dataset fails is not committed, so it is tried again at the
next start. ``trigger(availableNow=True)`` turns this into a scheduled batch job that
processes whatever appeared since the last run and stops.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relsync.functions.versions import is_version, newest_first, version_key
from relsync.plans.release_load import load_release
from relsync.plans.sink import Sink
from relsync.spec import DatasetSpec, Source


def checkpoint_location(spark: SparkSession, name: str, given: str | None = None) -> str:
    """Checkpoint path: the given one, else ``<spark.checkpoint.dir>/<name>``."""
    if given:
        return given
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:  # a directory set with SparkContext.setCheckpointDir (not under Spark Connect)
            base = spark.sparkContext.getCheckpointDir()
        except Exception:
            base = None
    if not base:
        raise ValueError("set spark.checkpoint.dir (a shared folder) or pass checkpoint=")
    return f"{base.rstrip('/')}/{name}"


def published_releases(spark: SparkSession, source: Source) -> DataFrame:
    """Streaming DataFrame of ``(version)``, one row per newly published release."""
    pattern = source.manifest_glob() + ".sha1"
    stream = spark.readStream.format("text").load(pattern)
    regex = source.version_regex()[:-1] + r"\.sha1$"
    version = F.regexp_extract(F.col("_metadata.file_path"), regex, 1)
    return stream.select(version.alias("version")).where(is_version(F.col("version")))


def watch_releases(spark: SparkSession, source: Source, specs: Sequence[DatasetSpec],
                   sink: Sink, checkpoint: str | None = None, load_type: str = "delta",
                   available_now: bool = True, **load_args) -> StreamingQuery:
    """Start the watcher; every micro-batch loads the newest release it discovered into the
    tables that hold an older one, and raises if any dataset failed."""

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        newest = (batch.select("version").distinct()
                  .orderBy(*newest_first(F.col("version"))).take(1))
        if not newest:
            return
        version = newest[0]["version"]
        held = {s.name: sink.last_success(s.name) for s in specs}
        behind = [s.name for s in specs if held[s.name] is None or version_key(held[s.name]) < version_key(version)]
        if not behind:
            return
        out = load_release(spark, specs, source, sink, version=version, datasets=behind,
                           load_type=load_type, **load_args)
        failed = out.where("status = 'failed'").collect()  # at most one row per dataset
        if failed:
            raise RuntimeError(f"release {version}: " + "; ".join(f"{r['dataset']}: {r['message']}" for r in failed))

    writer = (published_releases(spark, source).writeStream
              .foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_location(spark, "relsync_release_watch",
                                                                checkpoint)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 minutes")
    return writer.start()
