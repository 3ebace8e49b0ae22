"""Exact duplicates by progressive refinement (operator 12).

Texts are equal when identical after lower-casing A-Z. Rows are grouped by length, the groups
that hold several rows by a digest of the text's head, and the remaining ones by a digest of the
whole text; whole texts are read and hashed for the rows of surviving groups only (a text no
longer than the head is decided by the head's digest already).

Scale: texts are never shuffled, narrow rows are. Which rows survive the first two steps reaches
the scan as a bitmap over (length, head digest) hashes: eight bits or more per surviving group
up to MAX_BITS (32 MB) at any size of the corpus. A bit that two groups share only lets a row be
hashed that did not need it; the groups themselves are made of exact lengths and 256-bit digests.
All counts aggregate partially before their shuffle, and group facts return to rows through
``common.lookup`` (a counted broadcast, else salted copies), so a text, length or id that a third
of all rows share never gathers in one task.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relsync.llm.common import cut, lookup, tie_break

#: Characters of a text that its head digest covers.
HEAD = 512
#: Bits of one row of a bitmap (what Spark's bitmap functions use), and bounds of the whole bitmap.
_ROW_BITS, MIN_BITS, MAX_BITS = 32_768, 1 << 20, 1 << 28
_KEY = ["__octets", "__head", "__full"]


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased, and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")


def survivors(sizes: DataFrame) -> tuple[DataFrame, int]:
    """The (length, head digest) groups of ``sizes`` that hold several rows, as a bitmap
    (``__bucket``, ``__bits``), and its number of bits."""
    lengths = cut(_repeated(sizes, "__octets")).withColumnRenamed("__octets", "__of")
    same_length = lookup(sizes, lengths, F.col("__octets") == F.col("__of"), [F.col("__head")], "left_semi")
    groups = cut(_repeated(same_length, "__octets", "__head"))
    bits = MIN_BITS
    while bits < MAX_BITS and bits < 8 * groups.count():
        bits *= 2
    place = groups.select(_place(bits).alias("__place"))
    bitmap = place.groupBy(F.expr(f"__place div {_ROW_BITS}").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.col("__place") % _ROW_BITS).alias("__bits"))
    return cut(bitmap), bits


def _place(bits: int) -> Column:
    return F.pmod(F.xxhash64("__octets", "__head"), F.lit(bits))


def _marked() -> Column:
    """Whether the bitmap row ``__bits`` (null: no bit of its range is set) marks ``__place``."""
    byte = f"cast(conv(hex(substring(__bits, cast((__place % {_ROW_BITS}) div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.coalesce(F.expr(f"getbit({byte}, cast(__place % 8 as int)) = 1"), F.lit(False))


def _identified(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__octets``, ``__head`` and, for rows that the refinement leaves, ``__full``
    (else null): together equal for rows of equal texts."""
    text = F.col(text_col)
    # lower-casing A-Z changes no length, so lengths need no normalised text
    octets = F.coalesce(F.octet_length(text), F.lit(0))
    head = F.unhex(digest(normalised(F.substring(text, 1, HEAD))))
    bitmap, bits = survivors(cut(docs.select(octets.alias("__octets"), head.alias("__head"))))
    marked = docs.withColumns({"__octets": octets, "__head": head}).withColumn("__place", _place(bits))
    marked = lookup(marked, bitmap, F.expr(f"__place div {_ROW_BITS}") == F.col("__bucket"), [F.col("__head")], "left")
    whole = F.when(F.char_length(text) <= HEAD, F.col("__head")).otherwise(F.unhex(digest(normalised(text))))
    return marked.withColumn("__full", F.when(_marked(), whole)).drop("__place", "__bucket", "__bits")


def _decided(docs: DataFrame, id_col: str, text_col: str, carry: Mapping[str, Column]) -> DataFrame:
    """Narrow rows: the id and text key of every row of ``docs``, its group's size and whether it stays."""
    others = tie_break(docs.drop(text_col), id_col)
    rows = cut(_identified(docs, text_col).select(
        F.col(id_col).alias("__id"), F.xxhash64(*others).alias("__other"), F.monotonically_increasing_id().alias("__row"),
        *_KEY, *[c.alias(f"__c_{n}") for n, c in carry.items()]))
    groups = rows.where("__full is not null").groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.struct("__id", "__other", "__row")).alias("__top")).where("__n > 1")
    groups = cut(groups.select(*[F.col(k).alias(f"{k}_of") for k in _KEY], "__n", "__top"))
    # rows that did not survive have a null digest and meet no group
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{k}_of") for k in _KEY])
    out = lookup(rows, groups, same, [F.col("__row")], "left")
    alone = F.col("__n").isNull()
    return out.select(
        "__id", *_KEY, *[f"__c_{n}" for n in carry],
        F.when(alone, F.col("__id")).otherwise(F.col("__top.__id")).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("__row") == F.col("__top.__row"))).alias("kept"))


def find_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id`` (the id of the row of its group that stays),
    ``group_size`` (rows with an equal text, itself included), ``kept``, and the columns ``carry``
    names, computed from the row.

    Of equal texts the row with the greatest id stays; a null id is less than any other. Of rows
    that share that id as well, one stays: the one whose other columns hash greatest, else any of
    the rows that are then alike but for letter case. Null texts count as empty, and all empty texts
    are one group. An empty table gives no rows.
    """
    carry = dict(carry or {})
    found = _decided(docs, id_col, text_col, carry)
    return found.select(F.col("__id").alias(id_col), "keep_id", "group_size", "kept", *[F.col(f"__c_{n}").alias(n) for n in carry])


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns, by the rule of ``find_duplicates``.

    Rows come back by id and text: a text that stays under one id goes under all others. Only rows
    that share id and text with others are shuffled whole, after one of each is chosen per task.
    """
    of = ["__id", *_KEY]
    decided = _decided(docs, id_col, text_col, {})
    gone = decided.groupBy(*of).agg(F.count(F.lit(1)).alias("__n"), F.bool_or("kept").alias("__stays")).where("__n > 1 or not __stays")
    gone = cut(gone.select(*[F.col(k).alias(f"{k}_of") for k in of], "__stays"))
    rows = _identified(docs, text_col).withColumn("__id", F.col(id_col))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in of])
    met = lookup(rows, gone, same, [F.monotonically_increasing_id()], "left").select(*docs.columns, *of, "__stays")
    single = met.where("__stays is null").select(*docs.columns)
    order = F.struct(F.xxhash64(*tie_break(docs.drop(text_col), id_col)), F.xxhash64(text_col))
    one = met.where("__stays").groupBy(*of).agg(F.max_by(F.struct(*docs.columns), order).alias("__best"))
    return single.unionByName(one.select("__best.*"))


def exact_digest(docs: DataFrame) -> DataFrame:
    """``find_duplicates`` with ``text_sha256``, the digest of every row's normalised text."""
    return find_duplicates(docs, carry={"text_sha256": digest(normalised(F.col("text")))})


def oracle() -> str:
    """DuckDB SQL for ``exact_digest`` of ``documents``."""
    return f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)"""
