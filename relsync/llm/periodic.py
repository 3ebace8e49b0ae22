"""Periodic run detection (operator 11).

A run is a stretch of consecutive words whose smallest period is q, at least ``min_words`` and
``min_repeats`` x q words long, that no neighbouring word extends with that period: a phrase,
line or word repeated back to back.

Method (descending-LCP Kruskal): the suffixes of a text's word sequence are sorted by prefix
doubling, and neighbours in that order are edges weighted by their longest common prefix (LCP).
Edges are taken by decreasing LCP, as in Kruskal's algorithm: each unites two classes of
suffixes that share that many words, with union-find over ordered sets of positions (the smaller
set goes into the greater). Positions p < p + d that become adjacent in a set at LCP l share
exactly l words; if d is at most l the words from p to p + d + l have period d, and no smaller
one, since a smaller period would have put a position between them. If the word before p breaks
the period too, that stretch is a run. A run of period d is found from its first word, whose
LCP is its length less d, so edges too light for the shortest run are never built.

Scale: texts stay where they are, no shuffle. Texts are taken in slices of a bounded number of
bytes (or one text, if longer); the ranks take 4 bytes a word and doubling of the longest
repeated stretch, and only suffixes that still share their prefix with another are sorted again.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import WORD, in_batches, without
from relsync.llm.words import text_slices

MIN_WORDS, MIN_REPEATS = 6, 4
#: Bytes of text whose suffixes are sorted together (or one text, if longer).
_CHARS = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def text_words(text: str | None) -> list[bytes]:
    """The words of a text: runs of characters outside space and \\x09-\\x0D. Null: none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def suffix_edges(ids: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with their LCP, where it is ``least`` (1 or more) or greater.

    ``ids`` are the word numbers of several texts one after another, ``ends`` the position after
    the text each word belongs to. No word number may occur in two texts, so no LCP crosses texts.
    """
    n = len(ids)
    none = np.zeros(0, dtype=np.int64)
    if n < 2:
        return none, none, none

    def regroup(where: np.ndarray, classes: np.ndarray, following: np.ndarray):
        # the rank of a class is the number of suffixes before it, so a class keeps its rank
        # when others are split, and its parts get ranks inside its own range
        order = np.lexsort((following, classes))
        c, f = classes[order], following[order]
        new_class = np.concatenate(([True], c[1:] != c[:-1]))
        new_part = new_class | np.concatenate(([True], f[1:] != f[:-1]))
        at = np.arange(len(order))
        first = np.maximum.accumulate(np.where(new_class, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        size = np.diff(np.concatenate((np.flatnonzero(new_part), [len(order)])))
        shared = size[np.cumsum(new_part) - 1] > 1
        return where[order], (c + part - first), shared

    rank = np.zeros(n + 1, dtype=np.int32)
    rank[n] = -1
    everywhere = np.arange(n)
    where, ranks, shared = regroup(everywhere, np.zeros(n, dtype=np.int64), ids)
    rank[where] = ranks
    active, k = where[shared], 1
    levels = [(1, rank.copy())]
    related = active
    while len(active):
        # the k words after the first k; a text's end is less than any word
        after = np.minimum(active + k, n)
        following = np.where(active + k < ends[active], rank[after], -1)
        where, ranks, shared = regroup(active, rank[active].astype(np.int64), following)
        k *= 2
        rank = rank.copy()
        rank[where] = ranks
        active = where[shared]
        levels.append((k, rank))
        if k <= least:
            related = active
    if len(related) < 2:
        return none, none, none
    related = related[np.argsort(rank[related], kind="stable")]
    left, right = related[:-1], related[1:]
    lcp = np.zeros(len(left), dtype=np.int64)
    for k, ranks in reversed(levels):
        lcp += np.where(ranks[np.minimum(left + lcp, n)] == ranks[np.minimum(right + lcp, n)], k, 0)
    keep = lcp >= least
    return left[keep], right[keep], lcp[keep]


def seeds(left: list[int], right: list[int], lcp: list[int]):
    """(p, d, l) for positions p and p + d that become adjacent in an ordered set when edges of
    decreasing LCP are united, at LCP l. Edges must form a forest and be sorted, greatest first."""
    parent: dict[int, int] = {}
    sets: dict[int, list[int]] = {}

    def find(x: int) -> int:
        if x not in parent:
            parent[x] = x
            sets[x] = [x]
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j, common in zip(left, right, lcp, strict=True):
        a, b = find(i), find(j)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets.pop(b)
        parent[b] = a
        last = len(small) - 1
        for n, x in enumerate(small):
            at = bisect_left(large, x)
            # a neighbour in the other set counts unless one of the own set lies between
            if at and (n == 0 or small[n - 1] < large[at - 1]):
                yield large[at - 1], x - large[at - 1], common
            if at < len(large) and (n == last or small[n + 1] > large[at]):
                yield x, large[at] - x, common
        if len(small) * 8 < len(large):
            for x in small:
                insort(large, x)
        else:
            large.extend(small)
            large.sort()  # two sorted stretches: one merge


def find_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """Per text, given as its words, the runs (start, length, period) by start, then period.
    ``min_repeats`` is 2 or more."""
    if min_repeats < 2:
        raise ValueError("min_repeats must be 2 or more")
    sizes = [len(t) for t in texts]
    total, numbers = sum(sizes), count()
    ids = np.empty(total, dtype=np.int64)
    at = 0
    for words in texts:
        number = defaultdict(numbers.__next__)  # equal words of one text, and only they, share a number
        ids[at:at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        at += len(words)
    starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    ends = np.repeat(starts[1:], sizes)
    # a run of period d and length n is seeded at LCP n - d, which is least at d = 1 or at the
    # greatest d whose runs are still bound by min_words
    short = max(1, min_words // min_repeats)
    least = max(1, min(max(min_words - d, (min_repeats - 1) * d) for d in (1, short, short + 1)))
    left, right, lcp = suffix_edges(ids, ends, least)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = np.argsort(-lcp, kind="stable")
    left, right, lcp = left[order], right[order], lcp[order]
    for p, d, common in seeds(left.tolist(), right.tolist(), lcp.tolist()):
        if d * (min_repeats - 1) > common or d + common < min_words:
            continue
        t = int(np.searchsorted(starts, p, "right")) - 1
        if p == starts[t] or ids[p - 1] != ids[p + d - 1]:
            out[t].append((int(p - starts[t]), d + common, d))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that some run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change)[:-1] > 0
    return b" ".join(w for w, gone in zip(words, dropped.tolist(), strict=True) if not gone)


def annotate(
    docs: DataFrame, *, text_col: str = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS, keep_text: bool = True,
    runs: str = "runs", collapsed: str = "collapsed",
) -> DataFrame:
    """``docs``, all rows and columns, with ``runs`` (array of start, length, period; words numbered
    from 0, by start, then period) and ``collapsed`` (the text's words joined by one space, without
    those a run holds after its first period).

    Null, empty and wordless texts have no runs and collapse to the empty text. Rows are judged
    one by one: repeated rows and ids get the same result each. Columns of the two names are
    replaced. ``keep_text=False`` leaves the text out of the result. An empty table stays empty.
    """
    docs = without(docs, runs, collapsed)
    kept = [n for n, c in enumerate(docs.columns) if keep_text or c != text_col]
    at = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in RUN.names]))

    def run(batches):
        for batch in batches:
            found, short = [], []
            for texts in text_slices(batch.column(at), _CHARS):
                words = [text_words(t) for t in texts]
                for one, its in zip(words, find_runs(words, min_words, min_repeats), strict=True):
                    found.append([dict(zip(RUN.names, r, strict=True)) for r in its])
                    short.append(collapse(one, its).decode("utf-8", "surrogatepass"))
            columns = [batch.column(n) for n in kept] + [pa.array(found, kind), pa.array(short, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[n] for n in kept), runs, collapsed])

    fields = [docs.schema.fields[n] for n in kept] + [T.StructField(runs, T.ArrayType(RUN, False)), T.StructField(collapsed, T.StringType())]
    return in_batches(docs, run, T.StructType(fields))


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null where there is none."""
    ranked = F.transform(runs, lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))
    return F.array_min(ranked)


def planted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as the registered query reads them: with h the CRC-32 of the decimal id and g = h // 10,
    the text of a row with h % 10 = 0 and n > 0 words becomes periodic from word a = g % n on, with
    period 1 + (n - a) // (3 + g % 8). Other rows, and those with a null id, stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))
    chosen = docs.withColumn("__g", F.when((h % 10 == 0) & F.col(text_col).rlike(WORD), F.floor(h / 10).cast("long")))
    repeated = F.expr(
        "array_join(transform(sequence(0, size(__words) - 1), "
        "i -> get(__words, cast(if(i < __a, i, __a + (i - __a) % __p) as int))), ' ')"
    )
    parts = chosen.withColumn("__words", F.when(F.col("__g").isNotNull(), words))
    parts = parts.withColumn("__a", F.col("__g") % F.size("__words"))
    parts = parts.withColumn("__p", F.lit(1) + F.floor((F.size("__words") - F.col("__a")) / (F.lit(3) + F.col("__g") % 8)))
    text = F.when(F.col("__g").isNotNull(), repeated).otherwise(F.col(text_col))
    return parts.withColumn(text_col, text).drop("__g", "__words", "__a", "__p")


def run_digest(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): n_runs, the longest run's start, length, period and
    exponent_milli, and SHA-256 digests of all runs and of the collapsed text."""
    found = annotate(docs.select("doc_id", "text"), keep_text=False)
    top = longest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
