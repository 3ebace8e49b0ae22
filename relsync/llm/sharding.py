"""Sharding by vector bin packing (operator 7).

Groups (documents of equal text) are placed whole into a fixed number of shards so that
bytes, words and rows come out even together: group after group, largest first, goes to the
shard where the dot product of its vector (bytes, words, rows) with the shard's residual
capacity is highest. Only a group that holds more of a total than a shard's even share, and
so fits no shard, is split: by a hash of the id into pieces of a bundle's share, so a text
that a third of all rows share is spread over the shards.

Scale: placing is sequential, so what it sees is bounded, whatever the number of documents.
Groups that hold no more than a small share of every total are first bundled, whole, by a hash
of their text, into a fixed number of bundles per shard; of the groups that hold more there is
at most one per such share and total. Bundles, groups and pieces (``GRAIN`` times the number of
shards each, for each of the three totals) are placed on the driver; each document then looks
its shard up by its own hash. No text is shuffled for that. Slots come from distributed prefix
sums, so no shard is numbered in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relsync.llm.common import cut, hash_key, running_total, tie_break, without, word_count

#: Bundles per shard, and pieces of a shard's capacity into which a group that fits no shard is split.
GRAIN = 128
#: What each document takes beside its text.
OVERHEAD = 16
#: Ranges in which a shard's slots are counted.
SLOT_PARTS = 1024


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector: largest first (ties: earlier row first), each to the shard whose
    residual capacity has the greatest dot product with it (ties: smaller shard). Vectors and
    capacity are taken relative to an even share of each total."""
    total = vectors.sum(axis=0, dtype=np.float64)
    relative = vectors * (shards / np.where(total > 0, total, 1))
    residual = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int32)
    for i in np.argsort(-relative.max(axis=1, initial=0), kind="stable"):
        out[i] = at = int(np.argmax(residual @ relative[i]))
        residual[at] -= relative[i]
    return out


def _plan(narrow: DataFrame, shards: int, grain: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(large groups: text key, first item, pieces: 1 for a group that fits a shard), (rows of
    split groups that are items of their own: text key, id key, item) and (item -> shard). Items
    0 to shards * grain - 1 are the bundles; all three are bounded by a few times
    ``shards * grain`` rows."""
    spark = narrow.sparkSession
    bundles, three = shards * grain, ("size", "words", "rows")
    weight = [F.sum(c).cast("long").alias(c) for c in three]
    groups = cut(narrow.withColumn("rows", F.lit(1)).groupBy("text_key").agg(*weight))
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in three]).first()
    share = F.greatest(*[F.col(c) / F.lit(float(max(total[c], 1))) for c in three]) * bundles
    # in whole numbers, so that a group of exactly a shard's size is not split
    over = F.greatest(*[F.col(c) * shards > F.lit(total[c]) for c in three])
    groups = groups.withColumn("share", share).withColumn("over", over)
    # of each total at most ``bundles`` groups can hold more than one bundle's share
    large = groups.where("share > 1 OR over").withColumn("pieces", F.when(F.col("over"), F.ceil("share")).otherwise(1).cast("int"))
    single = F.col("over") & (F.col("rows") <= 2 * F.col("pieces"))
    split = large.where(~single).orderBy("text_key").collect()
    # a row of these holds half a bundle's share or more, so they are bounded alike
    alone = (
        narrow.join(F.broadcast(large.where(single).select("text_key")), "text_key")
        .withColumn("rows", F.lit(1)).groupBy("text_key", "id_key").agg(*weight).orderBy("text_key", "id_key").collect()
    )
    bundle = F.pmod("text_key", F.lit(bundles)).cast("int").alias("item")
    small = groups.where("share <= 1 AND NOT over").groupBy(bundle).agg(*weight).orderBy("item").collect()
    vectors, items, free = [[r[c] for c in three] for r in small], [r["item"] for r in small], bundles
    first, rows = [], []
    for r in split:
        first.append((r["text_key"], free, r["pieces"]))
        items += range(free, free + r["pieces"])
        vectors += [[r[c] / r["pieces"] for c in three]] * r["pieces"]
        free += r["pieces"]
    for r in alone:
        rows.append((r["text_key"], r["id_key"], free))
        items.append(free)
        vectors.append([r[c] for c in three])
        free += 1
    at = place(np.array(vectors, dtype=np.float64).reshape(-1, 3), shards)
    return (
        spark.createDataFrame(first, "__large_key long, __first int, __pieces int"),
        spark.createDataFrame(rows, "__row_key long, __row_id long, __row_item int"),
        spark.createDataFrame([(int(i), int(s)) for i, s in zip(items, at, strict=True)], "__item_no int, __item_shard int"),
    )


def assign(docs: DataFrame, shards: int = 40, *, grain: int = GRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows kept, with ``shard`` (0 to shards - 1).

    Rows of equal text stay together unless their group holds more of a total than a shard's
    even share; then its rows are split by a hash of the id. Rows equal in id and text always stay
    together. Null texts are a group of their own with 0 bytes and words. Columns of the
    name ``shard`` (and names that start with ``__`` used here) are replaced. An empty table
    gives an empty result. The same table gives the same shards again.
    """
    text, ident = F.col(text_col), F.col(id_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size")
    narrow = docs.select(hash_key(text).alias("text_key"), hash_key(ident).alias("id_key"), size, word_count(text).alias("words"))
    # the three tables are bounded by the number of shards, so every task can hold them
    large, alone, items = [F.broadcast(x) for x in _plan(cut(narrow), shards, grain)]
    docs = without(docs, "shard", "__key", "__id", "__item", *large.columns, *alone.columns, *items.columns)
    rows = docs.withColumns({"__key": hash_key(text), "__id": hash_key(ident)})
    rows = rows.join(large, F.col("__key") == F.col("__large_key"), "left")
    rows = rows.join(alone, (F.col("__key") == F.col("__row_key")) & (F.col("__id") == F.col("__row_id")), "left")
    piece = F.col("__first") + F.pmod("__id", F.col("__pieces"))
    item = F.coalesce("__row_item", piece, F.pmod("__key", F.lit(shards * grain))).cast("int")
    rows = rows.withColumn("__item", item).join(items, F.col("__item") == F.col("__item_no"), "left")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__item_shard").alias("shard"))


def with_slots(rows: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``rows`` (with ``shard``) and ``slot``: the row's number in its shard, gapless from 0, in
    the order of a hash of the id. Equal ids follow each other in the order of their other
    columns."""
    rows = without(rows, "slot", "__slot_key")
    order = tie_break(rows, id_col)
    rows = rows.withColumn("__slot_key", hash_key(F.col(id_col), seed=7))
    out = running_total(rows, ["shard"], "__slot_key", order, F.lit(1), "slot", SLOT_PARTS)
    return out.withColumn("slot", F.col("slot").cast("long")).drop("__slot_key")


def shard_documents(docs: DataFrame, shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (see ``assign`` and ``with_slots``)."""
    return with_slots(assign(docs, shards, id_col=id_col, text_col=text_col), id_col=id_col)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write sharded documents as one folder per shard, rows in slot order within each file."""
    sharded.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Placement by the law ``bytes``, one narrow row per document: id, size (UTF-8 bytes of the
    text and the overhead), text_crc32, law, shard, slot, grown_shard (null: not by key)."""
    text = F.col(text_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    placed = assign(docs.select(id_col, text_col), shards, id_col=id_col, text_col=text_col)
    narrow = cut(placed.select(id_col, size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), "shard"))
    return with_slots(narrow, id_col=id_col).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
