"""spark-submit job: load a release as described by a configuration file.

usage: spark-submit scripts/load_job.py CONFIG.toml DATABASE [--version V] [--datasets a,b]
                                        [--full] [--force] [--stop-on-error] [--statistics]

Views, tables and the ledger live in the session's catalog, so it has to be a persistent one
(``--conf spark.sql.catalogImplementation=hive`` and its metastore, or a catalog plugin as the
default). With an in-memory catalog a second run would know nothing of the first; the job
refuses that before any work unless ``--allow-in-memory`` is given.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from relsync.plans.config import load_config, max_workers, source_from_config, specs_from_config  # noqa: E402
from relsync.plans.release_load import load_release  # noqa: E402
from relsync.plans.sink import CatalogSink  # noqa: E402


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("config")
    ap.add_argument("database")
    ap.add_argument("--version")
    ap.add_argument("--datasets")
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--force", action="store_true")
    ap.add_argument("--stop-on-error", action="store_true")
    ap.add_argument("--statistics", action="store_true")
    ap.add_argument("--allow-in-memory", action="store_true")
    a = ap.parse_args(argv)
    cfg = load_config(a.config)
    spark = SparkSession.builder.appName("relsync-load").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    plugin = spark.conf.get("spark.sql.defaultCatalog", "spark_catalog") != "spark_catalog"
    if not a.allow_in_memory and not plugin and spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        print("the session's catalog is in memory: tables and ledger would be lost (see --allow-in-memory)", file=sys.stderr)
        return 2
    out = load_release(
        spark, specs_from_config(cfg), source_from_config(cfg), CatalogSink(spark, a.database),
        version=a.version, datasets=a.datasets.split(",") if a.datasets else None,
        load_type="full" if a.full else "delta", force=a.force,
        continue_on_error=not a.stop_on_error, max_workers=max_workers(cfg), statistics=a.statistics)
    out.show(truncate=False)
    return 0 if out.where("status = 'failed'").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
