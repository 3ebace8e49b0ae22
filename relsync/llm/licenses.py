"""License scan by canonical digests (operator 1).

A text is brought to a canonical form (ASCII case, copyright lines, punctuation and
equivalent spellings do not count), its SHA-256 digest is looked up by a hash join in the
digests of known licence texts and notices. Looked up are entire texts only: the whole
document, each of its blocks (between blank lines), each of its lines, and each run of blocks
that starts like a known text of several blocks and has as many; a licence's words inside other
prose are no match.

Scale: the text is read and normalised once, in the scan stage. Only one row per document
plus the units that matched reach the one shuffle, which is on (id, digest) with partial
aggregation; a line that a third of all documents hold is no shuffle key, unless the known
digests are too many to be held by every task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.llm.common import BROADCAST_ROWS, cut
from relsync.llm.known_licenses import APACHE_NOTICE, ISC, KNOWN, MIT  # noqa: F401

# Spellings that count as the same, after punctuation became spaces.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("whilst", "while"),
    ("https", "http"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t#*/;.-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
#: Values of the hash by which the first blocks of known texts are recognised.
STARTS = 4096
PUNCTUATION = r"[\x00-\x09\x0B-/:-@\[-`{-\x7F“”‘’–—…•©®™]+"


def canonical(text: Column) -> Column:
    """Canonical form, its lines still apart; null counts as empty."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    out = F.regexp_replace(out, PUNCTUATION, " ")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def joined(form: Column) -> Column:
    """A canonical form on one line."""
    return F.trim(F.regexp_replace(form, "[ \n]+", " "))


def blocks_of(form: Column) -> Column:
    """The blocks of a canonical form that are not empty, each on one line."""
    return F.filter(F.transform(F.split(form, "\n *\n[ \n]*"), lambda x: joined(x)), lambda x: x != "")


def _start(block: Column) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(STARTS)).cast("int")


def run_lengths(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> Column:
    """By the hash of a first block, the numbers of blocks of the known texts of several blocks
    that start so: a constant whose size does not grow with the number of known texts. Different
    blocks may share a hash; the digest decides."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(KNOWN if known is None else known), "license string, text string")
    blocks = known.where("license IS NOT NULL").select(blocks_of(canonical(F.col("text"))).alias("blocks")).where("size(blocks) > 1")
    found = blocks.groupBy(_start(F.col("blocks")[0]).alias("start")).agg(F.sort_array(F.collect_set(F.size("blocks"))).alias("sizes")).collect()
    sizes = {r["start"]: list(r["sizes"]) for r in found}
    return F.from_json(F.lit(json.dumps([sizes.get(i, []) for i in range(STARTS)])), "array<array<int>>")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(digest, license): the smallest licence name of each known text."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(KNOWN if known is None else known), "license string, text string")
    form = joined(canonical(F.col("text")))
    return (
        known.select("license", form.alias("form")).where("form <> '' AND license IS NOT NULL")
        .groupBy(F.sha2(F.col("form").cast("binary"), 256).alias("digest")).agg(F.min("license").alias("license"))
    )


def scan_licenses(
    docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per (id, canonical text) of ``docs``: ``digest`` of the whole canonical text,
    ``license`` (the known licence that the whole text is, else null), ``notices`` (names of
    the licences that whole blocks, lines or runs of blocks of it are, sorted, comma-joined, else empty) and
    ``copies`` (rows of that id and text).

    Null and empty texts: the digest of the empty text, no licence, no notices. Null ids are
    kept. Repeated rows count in ``copies``. Several known licences of one digest: the
    smallest name. An empty table gives an empty result; other columns play no part.
    """
    digests = cut(known_digests(docs.sparkSession, known))
    # about 100 bytes a row: held by every task while they are few, so that lines are looked up
    # where they are read; else joined by a shuffle on digests
    if digests.count() <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    form = docs.select(F.col(id_col), canonical(F.col(text_col)).alias("__form"))
    whole = form.select(id_col, joined(F.col("__form")).alias("__whole"), "__form", blocks_of(F.col("__form")).alias("__blocks"))
    lengths, blocks = run_lengths(docs.sparkSession, known), F.col("__blocks")
    runs = F.flatten(F.transform(blocks, lambda x, i: F.transform(
        F.filter(F.get(lengths, _start(x)), lambda n: i + n <= F.size(blocks)), lambda n: F.concat_ws(" ", F.slice(blocks, i + 1, n)))))
    lines = F.transform(F.split("__form", "\n"), lambda x: F.trim(x))
    parts = F.filter(F.concat(blocks, lines, runs), lambda x: x != "")
    unit = F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), digest(F.col("__whole")).alias("digest"))),
        F.transform(parts, lambda x: F.struct(F.lit(False).alias("whole"), digest(x).alias("digest"))),
    ))
    units = whole.select(id_col, digest(F.col("__whole")).alias("__of"), unit.alias("__unit"))
    found = (
        units.join(digests, F.col("__unit.digest") == F.col("digest"), "left")
        .where("__unit.whole OR license IS NOT NULL")
        .groupBy(id_col, F.col("__of").alias("digest"))
        .agg(
            F.min(F.when(F.col("__unit.whole"), F.col("license"))).alias("license"),
            F.array_join(F.array_sort(F.collect_set(F.when(~F.col("__unit.whole"), F.col("license")))), ",").alias("notices"),
            F.sum(F.col("__unit.whole").cast("long")).alias("copies"),
        )
    )
    return found.select(id_col, "digest", "license", "notices", "copies")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    out = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    out = f"regexp_replace({out}, {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"regexp_replace({out}, {_sql_text(PUNCTUATION)}, ' ', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _sql_joined(form: str) -> str:
    return f"trim(regexp_replace({form}, '[ \\n]+', ' ', 'g'), ' ')"


def oracle() -> str:
    """The same result over ``documents`` as DuckDB SQL."""
    rows = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in KNOWN)
    return f"""
WITH known AS (SELECT sha256(form) AS digest, min(license) AS license
               FROM (SELECT license, {_sql_joined(_sql_canonical('t'))} AS form FROM (VALUES {rows}) v(license, t))
               WHERE form <> '' GROUP BY 1),
forms AS (SELECT doc_id, {_sql_canonical('text')} AS form FROM documents),
docs AS (SELECT doc_id, sha256({_sql_joined('form')}) AS digest, count(*) AS copies, any_value(form) AS form FROM forms GROUP BY 1, 2),
all_forms AS (SELECT doc_id, sha256({_sql_joined('form')}) AS digest, form FROM forms),
parts AS (SELECT DISTINCT doc_id, digest, {_sql_joined("unnest(regexp_split_to_array(form, '\\n *\\n[ \\n]*'))")} AS part FROM all_forms
          UNION SELECT doc_id, digest, trim(unnest(string_split(form, chr(10))), ' ') FROM all_forms),
notices AS (SELECT p.doc_id, p.digest, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
            FROM parts p JOIN known k ON k.digest = sha256(p.part) WHERE p.part <> '' GROUP BY 1, 2)
SELECT d.doc_id, d.digest, k.license, coalesce(n.notices, '') AS notices, d.copies
FROM docs d LEFT JOIN known k ON k.digest = d.digest
LEFT JOIN notices n ON n.doc_id IS NOT DISTINCT FROM d.doc_id AND n.digest = d.digest"""
