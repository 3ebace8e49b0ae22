"""A catalog sink whose loads write only what changed.

Rows are dealt into key buckets (``operators.buckets``), and a generation is a list of buckets, each
held by the generation that wrote it last. A load digests the new snapshot per bucket, compares the
digests with those kept beside the current generation, and writes the buckets that differ; the
view of the new generation reads these from its own table and every other bucket from the table
that holds it. A generation's table goes when no kept generation reads a bucket of it.

Beside each generation table ``<table>__g<id>`` lies its list ``<table>__b<id>``: one row a bucket
with the generation that holds it, its rows and its digest. Both are written before the view is
switched, so a load that dies leaves readers, and the next load, on the list before.

The merged snapshot is computed twice, to be digested and (changed buckets only) to be written: what
is saved is the writing, and for readers of changes the reading, of all other buckets. Keys that
change all over the key space touch every bucket; choose as many buckets as the list and the view's
text allow (MAX_BUCKETS), large enough for a few files each.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.operators.buckets import BUCKET, bucket_digests, compare_buckets, key_bucket
from relsync.plans.sink import GEN_MARK, CatalogSink, _q
from relsync.streaming.change_feed import ChangeFeed

LIST_MARK = "__b"
#: Property of a list: the number of buckets that keys are dealt into.
BUCKETS_PROPERTY = "relsync.buckets"
MAX_BUCKETS = 4096

LIST_SCHEMA = T.StructType([
    T.StructField("bucket", T.IntegerType(), False),
    T.StructField("generation", T.StringType(), False),
    T.StructField("rows", T.LongType(), False),
    T.StructField("lane0", T.DecimalType(38, 0), False),
    T.StructField("lane1", T.DecimalType(38, 0), False),
])


class IncrementalSink(CatalogSink):
    """``CatalogSink`` that rewrites changed key buckets only.

    buckets        key buckets of a table, 1 to MAX_BUCKETS; a load with another number writes all
    rows_per_file  a written bucket is spread over so many files that none holds many more rows
    """

    def __init__(self, spark: SparkSession, database: str = "default", fmt: str = "parquet",
                 ledger_table: str = "relsync_load_ledger", keep_generations: int = 2, buckets: int = 256,
                 rows_per_file: int = 5_000_000, feed: ChangeFeed | None = None, keep_releases: int | None = None):
        super().__init__(spark, database, fmt, ledger_table, keep_generations, feed=feed, keep_releases=keep_releases)
        if not 1 <= buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
        self.buckets = buckets
        self.rows_per_file = rows_per_file

    # --- lists of buckets ------------------------------------------------------------------------
    def _list_name(self, generation: str) -> str:
        table, suffix = generation.rsplit(GEN_MARK, 1)
        return f"{table}{LIST_MARK}{suffix}"

    def bucket_list(self, generation: str) -> DataFrame | None:
        """The buckets of a generation (LIST_SCHEMA); None for one written whole by another sink."""
        name = self._list_name(generation)
        return self.spark.table(self.fq(name)) if self.exists(name) else None

    def holders(self, generation: str) -> dict[str, list[int]]:
        """The buckets a generation reads, by the generation that holds them (at most MAX_BUCKETS)."""
        listed = self.bucket_list(generation)
        out: dict[str, list[int]] = {}
        for r in listed.select("bucket", "generation").orderBy("generation", "bucket").collect() if listed is not None else []:
            out.setdefault(r["generation"], []).append(r["bucket"])
        return out

    def _body(self, generation: str) -> str:
        if self.bucket_list(generation) is None:
            return super()._body(generation)
        columns = ", ".join(_q(c) for c in self.spark.table(self.fq(generation)).columns if c != BUCKET)
        parts = [f"SELECT {columns} FROM {self.fq(g)} WHERE {BUCKET} IN ({', '.join(map(str, buckets))})"
                 for g, buckets in self.holders(generation).items()]
        # a table without rows has no bucket: its generation is read for its columns
        return " UNION ALL ".join(parts) or f"SELECT {columns} FROM {self.fq(generation)}"

    def _generation_rows(self, gen: str) -> DataFrame:
        return self.spark.sql(self._body(gen))

    def _drop_generation(self, table: str, gen: str) -> None:
        super()._drop_generation(table, gen)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(self._list_name(gen))}")

    def _drop_superseded(self, table: str, kept: list[str]) -> None:
        read = {g for k in kept for g in self.holders(k)}
        for old in self.generations(table):
            if old < kept[0] and old not in kept:
                if old not in read:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(old)}")
                self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(self._list_name(old))}")

    # --- writing ---------------------------------------------------------------------------------
    def _write_generation(self, table: str, df: DataFrame, keys: Sequence[str]) -> tuple[str, int]:
        """Write the buckets of ``df`` that differ from the current generation's, and the list."""
        if not keys:
            return super()._write_generation(table, df, keys)
        gen = self._new_name(table)
        # bounded by the number of buckets, and read three times
        digests = bucket_digests(df, keys, self.buckets).collect()
        new = self.spark.createDataFrame([tuple(r) for r in digests], T.StructType([f for f in LIST_SCHEMA if f.name != "generation"]))
        kept = self._reusable(table, df, new)
        written = [r["bucket"] for r in digests if r["bucket"] not in kept]
        files = max(1, -(-max((r["rows"] for r in digests), default=0) // self.rows_per_file))
        bucket = key_bucket(keys, self.buckets)
        rows = df.withColumn(BUCKET, bucket)
        if kept:
            rows = rows.where(F.col(BUCKET).isin(written)) if written else rows.where(F.lit(False))
        spread = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(files))
        rows.repartition(max(1, len(written) * files), F.col(BUCKET), spread).write.format(self.fmt).mode("errorifexists").partitionBy(BUCKET).saveAsTable(self.fq(gen))
        listed = [(r["bucket"], kept.get(r["bucket"], gen), r["rows"], r["lane0"], r["lane1"]) for r in digests]
        (self.spark.createDataFrame(listed, LIST_SCHEMA).coalesce(1).write.format(self.fmt).mode("errorifexists")
         .saveAsTable(self.fq(self._list_name(gen))))
        self.spark.sql(f"ALTER TABLE {self.fq(self._list_name(gen))} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{self.buckets}')")
        return gen, sum(r["rows"] for r in digests)

    def _reusable(self, table: str, df: DataFrame, new: DataFrame) -> dict[int, str]:
        """Buckets whose rows the current generation has already, with the generation that holds them.
        Empty where the table's columns, types or number of buckets differ."""
        current = self.current_generation(table) if self.exists(table) else None
        old = self.bucket_list(current) if current else None
        if old is None or self._bucket_count(current) != self.buckets:
            return {}
        have = [f for f in self.spark.table(self.fq(current)).schema if f.name != BUCKET]
        if [(f.name, f.dataType.simpleString()) for f in have] != [(f.name, f.dataType.simpleString()) for f in df.schema]:
            return {}
        same = compare_buckets(new, old).where("not changed").select("bucket")
        return {r["bucket"]: r["generation"] for r in old.join(same, "bucket").select("bucket", "generation").collect()}

    def _bucket_count(self, generation: str) -> int:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.fq(self._list_name(generation))}").collect()
        return int(next((r["value"] for r in rows if r["key"] == BUCKETS_PROPERTY), 0))

    # --- changes ---------------------------------------------------------------------------------
    def changed_buckets(self, older: str, newer: str) -> DataFrame:
        """``(bucket, rows_new, rows_old, changed)`` of two generations, from their lists alone."""
        return compare_buckets(self.bucket_list(newer), self.bucket_list(older))

    def _changed_rows(self, table: str, gen: str) -> tuple[DataFrame, DataFrame | None]:
        """Only the buckets that the staged generation wrote, and those that vanished, can differ."""
        current = self.current_generation(table) if self.exists(table) else None
        old = self.bucket_list(current) if current else None
        new = self.bucket_list(gen)
        if old is None or new is None or self._bucket_count(current) != self._bucket_count(gen):
            return super()._changed_rows(table, gen)
        new_held, old_held = self.holders(gen), self.holders(current)
        reused = {b for g, held in new_held.items() if g != gen for b in held}
        written = {gen: new_held.get(gen, [])}
        before = {g: [b for b in held if b not in reused] for g, held in old_held.items()}
        return self._rows_of(gen, written), self._rows_of(current, before)

    def _rows_of(self, generation: str, held: dict[str, list[int]]) -> DataFrame:
        """The rows of some buckets of a generation, given by the generations that hold them."""
        out = self.spark.table(self.fq(generation)).drop(BUCKET).limit(0)
        for g, buckets in held.items():
            if buckets:
                out = out.unionByName(self.spark.table(self.fq(g)).where(F.col(BUCKET).isin(buckets)).drop(BUCKET))
        return out
