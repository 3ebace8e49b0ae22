"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word, where a contract counts words: a run of characters outside space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared checkpoint folder, its lineage cut.

    The folder is the one the session names (``spark.checkpoint.dir``). Where it names
    none, a temporary one serves a single-machine session; on a cluster that is an error,
    since other machines could not read it back.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="relsync-checkpoints-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Rows up to which a lookup table is held by every task.
BROADCAST_ROWS = 200_000
#: Parts into which each key is split where a lookup table is larger.
SALTS = 64


def lookup(rows: DataFrame, small: DataFrame, condition: Column, spread: list[Column], how: str = "inner") -> DataFrame:
    """Join ``rows`` with a table of one row per key that is much smaller, safe for hot keys.

    ``small`` should be cut: its rows are counted. Up to BROADCAST_ROWS every task holds it and
    ``rows`` stay where they are. A larger one is repeated SALTS times and ``rows`` are dealt
    over the repetitions by a hash of ``spread``, so no key's rows meet in one task.
    """
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), condition, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)))
    repeated = small.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, condition & (F.col("__salt") == F.col("__copy")), how).drop("__salt", "__copy")


#: Bytes of rows that one Arrow batch brings to a Python worker.
BATCH_BYTES = 16 << 20


def in_batches(docs: DataFrame, run, schema) -> DataFrame:
    """``docs.mapInArrow`` with batches of bounded size. A task holds a batch several times (in the
    JVM, on its way and in Python), so the session's limit is lowered to BATCH_BYTES if it is
    greater; a single row may still be larger."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    size = int(conf.get(name, str(4 * BATCH_BYTES)).rstrip("b"))
    if size <= 0 or size > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return docs.mapInArrow(run, schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (names match case-insensitively)."""
    gone = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in gone]
    return df.drop(*clash) if clash else df


_PLAIN = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def tie_break(df: DataFrame, *first: str) -> list[Column]:
    """Columns to order by: ``first``, then all others of plain types, so that only rows equal in
    all of them are interchangeable and a task that runs again gives the same result."""
    rest = [c for c, t in df.dtypes if c not in first and (t in _PLAIN or t.startswith("decimal"))]
    return [F.col(f"`{c}`") for c in (*first, *rest)]


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(*parts: Column, seed: int = 0) -> Column:
    """A reproducible, uniformly spread key of 60 bits: the head of an MD5 digest.

    SQL engines can compute the same value, so a query's result can be checked elsewhere.
    Nulls are told apart from empty strings.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("<null>")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


#: Number of values of hash_key.
KEYS = 1 << 60


def running_total(
    df: DataFrame, group: list[str], key: str, order: list[Column], value: Column, name: str, buckets: int
) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same group that come
    before this row, in the order (``key``, ``order``). ``key`` must be a ``hash_key``.

    Distributed: the key's range is cut into ``buckets`` equal parts. Rows are summed per
    (group, part) with partial aggregation, the parts' sums are added up per group, and the
    rows are numbered inside their part only, so no task holds more than a part of a group.
    """
    part = F.floor(F.col(key) / F.lit(-(-KEYS // buckets))).cast("int")
    df = df.withColumn("__part", part)
    sums = df.groupBy(*[F.col(c).alias(f"__of_{c}") for c in group], F.col("__part").alias("__of")).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*[f"__of_{c}" for c in group]).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*group, "__part").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("__part").eqNullSafe(F.col("__of"))
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    out = lookup(rows, cut(sums), same, [F.col(key)])
    return out.withColumn(name, F.col("__base") + F.col("__inside")).drop("__base", "__inside", "__part", "__of", *[f"__of_{c}" for c in group])
