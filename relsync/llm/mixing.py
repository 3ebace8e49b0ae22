"""Mixing sources to target weights (operator 5).

Every document gets a hash-random key. Within each source documents stand in key order;
the mix takes whole passes over the source (epochs) and then the documents from the
start of the order up to the source's exact budget. Budgets are words: the sources share a
total by weight, no source gives more than ``limit`` times its own size, and what that
leaves over is shared again by weight among the others.

Scale: the order is never made as a whole. The key's range is cut into equal parts, sizes
are summed per (source, part) with partial aggregation, and the prefix sums of these sums
tell in which part the budget ends; only that part's documents are sorted. A document's
share then follows from its own key and its source's cut, one small row per source that comes
to the documents by a lookup without hot keys, so a source may hold a third of all rows. While
sources are few, texts are never shuffled.
Keys depend on ids alone: reruns and lost executors change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relsync.llm.common import KEYS, WORD, cut, hash_key, lookup, without, word_count

#: Parts of the key range per source.
PARTS = 4096
_WIDTH = KEYS // PARTS


def source_targets(sizes: DataFrame, weights: list[float], share: float, limit: float) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) with ``target``, in words.

    Sources by code point, null last, weigh ``weights``, repeating. They share ``share``
    times all sizes by weight; a target stops at ``limit`` times its source's size and the
    excess is shared again by weight until none is above. Closed form: the level (words per
    unit of weight) is fixed by the sources in order of the level at which each stops. One
    row per source is sorted in one task, twice; the documents are not.
    """
    everything = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(everything) - 1) % len(weights) + 1)
    df = sizes.withColumn("weight", pick).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    level_order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    df = df.withColumn("capped", F.sum("cap").over(level_order.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn("open_weight", F.sum("weight").over(level_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    # the level if this source and those after it are open and those before it have stopped
    level = (budget - F.coalesce("capped", F.lit(0.0))) / F.col("open_weight")
    df = df.withColumn("try", F.when(level * F.col("weight") <= F.col("cap"), level))
    # the first source that stays open settles the level: from there on the level of the sources
    # after it only falls, so it is the greatest. Where all have stopped there is none
    df = df.withColumn("level", F.max("try").over(whole))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap")))
    return df.select("source", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    ident = F.col(id_col)
    return docs.select(
        ident.alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), hash_key(ident).alias("key"),
    )


def source_cuts(keyed: DataFrame, weights: list[float], share: float, limit: float) -> DataFrame:
    """Per source: source_size, target, ``epochs`` (whole passes), ``rest`` (words of the last,
    partial pass), ``cut_key`` (documents with smaller keys are taken once more, those with
    greater keys are not) and ``cut_start`` (words before the documents of the cut key)."""
    part = F.floor(F.col("key") / F.lit(_WIDTH)).alias("part")
    sums = cut(keyed.groupBy("source", part).agg(F.sum("size").alias("words")))
    sizes = sums.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    whole = F.floor(F.col("target")).cast("long")
    plan = source_targets(sizes, weights, share, limit).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    )
    plan = cut(plan.withColumn("rest", whole - F.col("epochs") * F.col("source_size")))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranged = sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)).cast("long"))
    p, r = plan.alias("p"), ranged.alias("r")
    # the one part of each source in which the rest ends
    ends = cut(r.join(p, F.col("r.source").eqNullSafe(F.col("p.source"))).where(
        (F.col("p.rest") >= F.col("r.base")) & (F.col("p.rest") < F.col("r.base") + F.col("r.words"))
    ).select(F.col("r.source").alias("of"), F.col("r.part").alias("end"), "r.base", "p.rest"))
    at_end = lookup(keyed.withColumn("part", part), ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("end")), [F.col("key")])
    groups = at_end.groupBy("source", "base", "rest", "key").agg(F.sum("size").alias("words"))
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("cut_start", F.col("base") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
    at = groups.where("rest >= cut_start AND rest < cut_start + words").select("source", F.col("key").alias("cut_key"), "cut_start")
    c = at.alias("c")
    return p.join(c, F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        "p.source", "source_size", "target", "epochs", "rest",
        # a source whose rest is 0 of 0 words has no cut: nothing beyond whole passes
        F.coalesce("cut_key", F.lit(-1)).cast("long").alias("cut_key"), F.coalesce("cut_start", F.lit(0)).cast("long").alias("cut_start"),
    )


def mix(
    docs: DataFrame, *, weights: list[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, ``taken`` (the words the mix
    takes of it, repeats counted) and source.

    Sizes are words; null and empty texts have size 0 and are taken 0 times in words. A null
    source is a source of its own. Per source the taken words sum to the whole part of the
    target exactly; the last document of the order is taken in part. Documents of equal key
    (repeated ids, null ids) follow each other by size; equal rows are interchangeable, so
    results are the same as a multiset. An empty table gives an empty result. Columns other
    than the three named play no part.
    """
    keyed = cut(_keyed(docs, id_col, text_col, source_col))
    cuts = cut(source_cuts(keyed, list(weights), share, limit).withColumnRenamed("source", "of"))
    rows = lookup(keyed, cuts, F.col("source").eqNullSafe(F.col("of")), [F.col("key")]).drop("of")
    clear = rows.where("key <> cut_key").withColumn("partly", F.when(F.col("key") < F.col("cut_key"), F.col("size")).otherwise(F.lit(0)))
    before = Window.partitionBy("source").orderBy("id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("key = cut_key").withColumn("start", F.col("cut_start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    left = F.greatest(F.lit(0), F.least(F.col("rest") - F.col("start"), F.col("size")))
    edge = edge.withColumn("partly", left)
    out = clear.unionByName(edge.drop("start"))
    taken = (F.col("epochs") * F.col("size") + F.col("partly")).cast("long")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), "source")


def mix_documents(
    docs: DataFrame, *, weights: list[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as the mix takes it, all
    columns kept. Texts stay whole: the rows at the cut are taken once more if at least half
    of their words lie within the budget, so a source's words differ from its target by half
    of such a document at most. Documents without words come once per whole pass of their
    source, and once at least, since they take nothing from any budget.
    """
    keyed = cut(_keyed(docs, id_col, text_col, source_col))
    c = cut(source_cuts(keyed, list(weights), share, limit))
    edges = c.select(F.col("source").alias("of"), F.col("cut_key").alias("edge_key"))
    at = lookup(keyed, edges, F.col("source").eqNullSafe(F.col("of")) & (F.col("key") == F.col("edge_key")), [F.col("key")])
    at = at.groupBy("source").agg(F.sum("size").alias("edge"))
    a = at.alias("a")
    cuts = cut(c.alias("c").join(a, F.col("c.source").eqNullSafe(F.col("a.source")), "left").select(
        F.col("c.source").alias("__mix_source"), F.col("epochs").alias("__mix_epochs"), F.col("cut_key").alias("__mix_cut"),
        F.coalesce(2 * (F.col("rest") - F.col("cut_start")) >= F.col("edge"), F.lit(False)).alias("__mix_edge")))
    docs = without(docs, *cuts.columns, "__mix_key", "__mix_copies")
    keyed_docs = docs.withColumn("__mix_key", hash_key(F.col(id_col)))
    rows = lookup(keyed_docs, cuts, F.col(source_col).cast("string").eqNullSafe(F.col("__mix_source")), [F.col("__mix_key")])
    at_cut = (F.col("__mix_key") == F.col("__mix_cut")) & F.col("__mix_edge")
    copies = F.col("__mix_epochs") + F.when((F.col("__mix_key") < F.col("__mix_cut")) | at_cut, 1).otherwise(0)
    wordless = ~F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    copies = F.when(wordless, F.greatest(F.lit(1), copies)).otherwise(copies).cast("int")
    rows = rows.withColumn("__mix_copies", copies).where("__mix_copies > 0")
    rows = rows.withColumn("__mix_copies", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _sql_words(text: str) -> str:
    return f"coalesce(length(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')), 0)"


def oracle(weights: list[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> str:
    """``mix`` over ``documents`` as DuckDB SQL."""
    ws = ", ".join(repr(float(w)) for w in weights)
    return f"""
WITH d AS (SELECT doc_id, source, {_sql_words('text')}::BIGINT AS size,
                  ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '<null>')), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, ([{ws}])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} + 1)::INT]::DOUBLE AS weight,
             source_size * {float(limit)!r}::DOUBLE AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
             sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
             (sum(source_size) OVER ()) * {float(share)!r}::DOUBLE AS budget FROM w),
l AS (SELECT *, max(CASE WHEN (budget - capped) / open_weight * weight <= cap THEN (budget - capped) / open_weight END) OVER () AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(level * weight, cap) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (SELECT *, floor(target)::BIGINT - epochs * source_size AS rest FROM e),
p AS (SELECT d.doc_id, d.size, d.source, r.source_size, r.target, r.epochs, r.rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source, source_size, target,
       (epochs * size + greatest(0, least(rest - start, size)))::BIGINT AS taken FROM p"""
