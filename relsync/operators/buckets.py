"""Key buckets and their digests: which parts of a snapshot differ from another one's.

A row's bucket is a hash of its key, so a key stays in its bucket from release to release. A
bucket's digest is its number of rows and two sums over row digests: equal for equal sets of rows
in any order, and computed by one aggregation with partial sums per task.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.functions.types import comparable, json_text

BUCKET = "__bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, 0 to ``buckets`` - 1: the first 60 bits of the MD5 of its key values as a
    JSON array of texts, modulo ``buckets``. Other engines can compute the same."""
    text = json_text(F.array(*[F.col(f"`{k}`").cast("string") for k in keys]))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets)).cast("int")


def row_lanes(schema: T.StructType) -> list[Column]:
    """Two numbers of 60 bits that depend on every value of a row: parts of the SHA-256 of its JSON
    text, columns by name, nulls kept, maps by their sorted entries."""
    fields = sorted(schema.fields, key=lambda f: f.name.lower())
    row = F.struct(*[comparable(F.col(f"`{f.name}`"), f.dataType).alias(f.name.lower()) for f in fields])
    digest = F.sha2(json_text(row).cast("binary"), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 16)]


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``(bucket, rows, lane0, lane1)`` of every bucket that holds rows."""
    lanes = row_lanes(df.schema)
    rows = df.select(key_bucket(keys, buckets).alias("bucket"), *[c.alias(f"lane{i}") for i, c in enumerate(lanes)])
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(f"lane{i}").cast("decimal(38,0)").alias(f"lane{i}") for i in range(len(lanes))])


def compare_buckets(new: DataFrame, old: DataFrame) -> DataFrame:
    """``(bucket, rows_new, rows_old, changed)`` of every bucket that either side has."""
    facts = ("rows", "lane0", "lane1")
    a = new.select("bucket", *[F.col(c).alias(f"{c}_new") for c in facts])
    b = old.select("bucket", *[F.col(c).alias(f"{c}_old") for c in facts])
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_new").eqNullSafe(F.col(f"{c}_old")) for c in facts])
    return a.join(b, "bucket", "full_outer").select(
        "bucket", F.coalesce("rows_new", F.lit(0)).alias("rows_new"), F.coalesce("rows_old", F.lit(0)).alias("rows_old"), (~same).alias("changed"))
