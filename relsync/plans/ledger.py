"""Load ledger: one row per load attempt; the latest success per dataset decides skips."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("load_timestamp", T.TimestampType(), False),
        T.StructField("start_time", T.TimestampType(), True),
        T.StructField("end_time", T.TimestampType(), True),
        T.StructField("version", T.StringType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("rows_loaded", T.LongType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
    ]
)

SUCCESS = "success"
FAILURE = "failure"


def ledger_row(version: str, dataset: str, success: bool, rows_loaded: int,
               start_time: dt.datetime, end_time: dt.datetime,
               error_message: str | None = None, run_id: str | None = None,
               load_timestamp: dt.datetime | None = None) -> tuple:
    """A ledger record; a failure records 0 rows and its message on one line."""
    if error_message is not None:
        error_message = " ".join(error_message.split("\n"))
    return (
        run_id or uuid.uuid4().hex,
        load_timestamp or dt.datetime.now(dt.timezone.utc),
        start_time,
        end_time,
        version,
        dataset,
        int(rows_loaded) if success else 0,
        SUCCESS if success else FAILURE,
        None if success else error_message,
    )


def ledger_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def successes(ledger: DataFrame, dataset: str | None = None) -> DataFrame:
    cond = F.col("status") == SUCCESS
    if dataset is not None:
        cond = cond & (F.col("dataset_name") == dataset)
    return ledger.where(cond)


def last_success(ledger: DataFrame, dataset: str) -> DataFrame:
    """The latest successful load of one dataset (0 or 1 row); a top-1, not a full sort.
    Of loads at the same instant the greatest ``run_id`` counts, here and below."""
    return successes(ledger, dataset).orderBy(F.col("load_timestamp").desc(), F.col("run_id").desc()).limit(1)


def last_success_version(ledger: DataFrame, dataset: str) -> str | None:
    rows = last_success(ledger, dataset).select("version").take(1)
    return rows[0]["version"] if rows else None


def latest_per_dataset(ledger: DataFrame) -> DataFrame:
    """``(dataset_name, version, load_timestamp, rows_loaded)`` of each dataset's latest success.

    ``max_by`` aggregates partially before the shuffle, so a dataset with very many
    ledger rows still costs one row per task.
    """
    latest = F.max_by(
        F.struct("version", "load_timestamp", "rows_loaded"), F.struct("load_timestamp", "run_id")
    )
    return (
        successes(ledger)
        .groupBy("dataset_name")
        .agg(latest.alias("l"))
        .select("dataset_name", "l.version", "l.load_timestamp", "l.rows_loaded")
    )


def latest_per_dataset_window(ledger: DataFrame) -> DataFrame:
    """Same as :func:`latest_per_dataset`, with ``row_number`` (the SQL formulation)."""
    w = Window.partitionBy("dataset_name").orderBy(F.col("load_timestamp").desc(), F.col("run_id").desc())
    return (
        successes(ledger)
        .withColumn("__rn", F.row_number().over(w))
        .where("__rn = 1")
        .select("dataset_name", "version", "load_timestamp", "rows_loaded")
    )
