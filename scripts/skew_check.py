"""Skew experiment: one key holding a third of all rows, through the key operators.

Derives a skewed copy of ``lineitem`` (every third row gets order key 0), runs the
primary-key check, the orphan-key check and the orphan-row check on it, and reports per
stage the largest and the median number of shuffle records a task read, from Spark's
event log in a scratch folder. usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from relsync.operators.checks import key_violations, orphan_keys, orphan_rows  # noqa: E402
from relsync.operators.merge import stale_rows  # noqa: E402
from relsync.plans.ledger import latest_per_dataset  # noqa: E402
from relsync.sources.manifest import last_listing_wins  # noqa: E402


def read_events(ev_dir: str) -> list[dict]:
    import zstandard

    out = []
    for f in sorted(glob.glob(f"{ev_dir}/*/*")):
        if "appstatus" in f:
            continue
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        out += [json.loads(x) for x in raw.decode().splitlines() if x.strip()]
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-")
    ev = os.path.join(scratch, "events")
    os.makedirs(ev)
    spark = (SparkSession.builder.master("local[8]").appName("skew")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
             .config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    n = li.count()
    # fixture only: a hot key on every third row (key 0 exists in orders only if it did before)
    hot = li.withColumn("l_orderkey", F.when(F.monotonically_increasing_id() % 3 == 0, F.lit(0))
                        .otherwise(F.col("l_orderkey") + 10_000_000))
    hot = hot.repartition(16).cache()
    hot.count()
    # the same hot key as a ledger's dataset and as a manifest's path
    ledger = hot.select(F.col("l_orderkey").cast("string").alias("dataset_name"),
                        F.col("l_shipdate").alias("load_timestamp"),
                        F.col("l_linenumber").cast("string").alias("version"),
                        F.col("l_partkey").alias("rows_loaded"), F.lit("success").alias("status"))
    listing = hot.select(F.col("l_orderkey").cast("string").alias("path"),
                         F.sha1(F.col("l_partkey").cast("string")).alias("sha1"),
                         F.monotonically_increasing_id().alias("__pos"))
    runs = {
        "key_violations": lambda: key_violations(hot, ["l_orderkey"]),
        "orphan_keys": lambda: orphan_keys(hot, orders, ["l_orderkey"], ["o_orderkey"]),
        "orphan_rows": lambda: orphan_rows(hot, orders, ["l_orderkey"], ["o_orderkey"]),
        "stale_rows": lambda: stale_rows(orders, hot.select(F.col("l_orderkey").alias("o_orderkey")),
                                         ["o_orderkey"]),
        "latest_per_dataset": lambda: latest_per_dataset(ledger),
        "last_listing_wins": lambda: last_listing_wins(listing),
    }
    for name, fn in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
    spark.stop()

    events = read_events(ev)
    group_of_job, stages_of_job = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group_of_job[e["Job ID"]] = e.get("Properties", {}).get("spark.jobGroup.id")
            stages_of_job[e["Job ID"]] = [s["Stage ID"] for s in e["Stage Infos"]]
    group_of_stage = {s: group_of_job[j] for j, ss in stages_of_job.items() for s in ss}
    reads: dict[int, list[int]] = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            r = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            if r:
                reads.setdefault(e["Stage ID"], []).append(r)
    print(f"rows={n}, hot key rows={n // 3}")
    print("| operator | stage | tasks | max records read by a task | median |")
    print("|---|---|---|---|---|")
    for stage, rs in sorted(reads.items()):
        g = group_of_stage.get(stage)
        if g in runs:
            print(f"| {g} | {stage} | {len(rs)} | {max(rs)} | {int(statistics.median(rs))} |")


if __name__ == "__main__":
    main()
