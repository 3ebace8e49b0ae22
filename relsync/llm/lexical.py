"""Ranked lexical search, reversed: documents stream past an index of the items (operator 13).

Many items are searched in many documents. Instead of indexing the documents, the items' terms
are: an inverted index (term to the items that hold it) is broadcast, each document's term counts
run through it once, and every task keeps a heap of the best ``k`` documents of each item. The
tasks' heaps are then merged by a ranking per item.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
With N documents that hold a term, L terms in all, n terms in a document, df documents that hold
a term and tf occurrences in the document (all else 64-bit integers, division rounding down)::

    w     = floor(1000 * ln((2 N + 2) / (2 df + 1)))        in doubles
    m     = 100 - 90 + (90 n N) div L
    score = sum over the item's terms, once each, of w * ((10^9 tf) div (1000 tf + 8 m))

Two passes over the documents: one counts N, L and the document frequencies of the items' terms,
one ranks. Neither shuffles a document. A task sends at most one count a term, then ``k`` rows an
item. The items are the stated query set: they are taken in blocks of a bounded number of
characters by hash, so they may grow; each block is two more passes.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import in_batches
from relsync.llm.words import text_slices

K = 10
#: Characters of item text that one pass takes along.
BLOCK_CHARS = 16_000_000
#: Bytes of text whose terms are counted, and cells of (document, item) scores held, at a time.
_CHARS, _CELLS = 1 << 20, 1 << 20

#: Term bytes map to themselves, A-Z to a-z, all other bytes to a space.
_TERM = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else b if b >= 0x80 or chr(b) in string.ascii_lowercase + string.digits else 0x20
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, repeats included. Null: none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


@dataclass
class Index:
    """Terms of a block of items: ``number`` of each term, and for each term the items that hold it
    (``items[offsets[t]:offsets[t + 1]]``); ``ids`` are the items' ids."""

    ids: list
    number: dict[bytes, int]
    offsets: np.ndarray
    items: np.ndarray


def index_items(rows: list[tuple]) -> Index:
    """The index of (id, text) rows."""
    number: dict[bytes, int] = {}
    pairs = sorted({(number.setdefault(t, len(number)), n) for n, (_, text) in enumerate(rows) for t in terms(text)})
    of = np.array([t for t, _ in pairs], dtype=np.int64)
    offsets = np.searchsorted(of, np.arange(len(number) + 1))
    return Index([i for i, _ in rows], number, offsets, np.array([n for _, n in pairs], dtype=np.int64))


def weights(n_docs: int, frequencies: dict[int, int], n_terms: int) -> np.ndarray:
    """The weight of each term by its document frequency (0 where no document holds it)."""
    out = np.zeros(n_terms, dtype=np.int64)
    for t, df in frequencies.items():
        out[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out


class Best:
    """A heap of the ``k`` best (score, then smallest id, null ids last) documents of each item."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, dtype=np.int64)  # a score below cannot enter

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Scores of documents (rows) for all items (columns)."""
        floor = self.least
        if len(ids) > self.k:
            # what is less than the k-th best of these documents cannot be among the best
            floor = np.maximum(floor, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        for d, i in zip(*(a.tolist() for a in np.nonzero(scores >= floor)), strict=True):
            entry = (int(scores[d, i]), ids[d] is not None, 0 if ids[d] is None else -ids[d])
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = max(1, heap[0][0])

    def rows(self):
        """(item number, id, score) of all heaps."""
        for i, heap in enumerate(self.heaps):
            for score, known, minus in heap:
                yield i, -minus if known else None, score


def score_slice(counts: list[tuple[int, Counter]], index: Index, weight: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """Scores of documents, given as (number of terms, counts of indexed terms), for all items.

    Sums are taken in doubles, exactly: a term adds less than 2^15 * 2^20, so below 2^53 there is
    room for 2^18 different terms that an item shares with a document; beyond that, in integers.
    """
    width = len(index.ids)
    sizes = [len(c) for _, c in counts]
    total = sum(sizes)
    term = np.fromiter((t for _, c in counts for t in c), np.int64, total)
    tf = np.fromiter((f for _, c in counts for f in c.values()), np.int64, total)
    # 90 n N may leave 64 bits in a corpus of very many long texts: Python's integers do not
    m = np.array([10 + (90 * n * n_docs) // n_all for n, _ in counts], dtype=np.int64)
    doc = np.repeat(np.arange(len(counts)), sizes)
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    first = index.offsets[term]
    spread = index.offsets[term + 1] - first
    reached = np.cumsum(spread)
    exact = max(sizes, default=0) < 1 << 18
    out = np.zeros(len(counts) * width, dtype=np.int64)
    at = 0
    while at < total:
        # a bounded number of (document, term, item) triples at a time
        end = max(at + 1, int(np.searchsorted(reached, (reached[at - 1] if at else 0) + _CELLS, "right")))
        some = spread[at:end]
        inside = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
        cell = np.repeat(doc[at:end] * width, some) + index.items[np.repeat(first[at:end], some) + inside]
        added = np.repeat(part[at:end], some)
        if exact:
            out += np.bincount(cell, weights=added, minlength=len(out)).astype(np.int64)
        else:
            np.add.at(out, cell, added)
        at = end
    return out.reshape(len(counts), width)


def _indexed(text: str | None, number: dict[bytes, int]) -> tuple[int, Counter]:
    found = terms(text)
    counted = Counter(found)
    return len(found), Counter({number[t]: f for t, f in counted.items() if t in number})


def _blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int):
    """The items' rows in blocks of about ``block_chars`` characters, in an order that does not change."""
    chars = items.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
    n = max(1, -(-chars // block_chars))
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(text_col, item_col), F.lit(n)).alias("block"))
    for b in range(n):
        # bounded by the block's expected number of characters; items are short texts
        yield [(r["item"], r["text"]) for r in rows.where(F.col("block") == b).orderBy("item", "text").collect()]


def _statistics(docs: DataFrame, at: int, shared) -> tuple[int, int, dict[int, int]]:
    """N, L and the document frequency of every indexed term."""

    def run(batches):
        holding, all_terms, frequency = 0, 0, Counter()
        for batch in batches:
            for texts in text_slices(batch.column(at), _CHARS):
                for text in texts:
                    n, found = _indexed(text, shared.value.number)
                    holding, all_terms = holding + (n > 0), all_terms + n
                    frequency.update(found.keys())
        rows = [(-2, holding), (-1, all_terms), *frequency.items()]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.int64())], names=["term", "n"])

    counts = in_batches(docs, run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = {r["term"]: r["n"] for r in counts.collect()}  # at most one row a term of the block
    return out.pop(-2, 0), out.pop(-1, 0), out


def search(
    docs: DataFrame, items: DataFrame, *, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(item id, rank, document id, score): the ``k`` documents of each item row that score highest,
    above 0, ranked from 1; equal scores by ascending document id, null ids last.

    Null, empty and termless documents count nowhere and are never found; such items find nothing.
    Item ids may be null or repeat: every item row is searched by itself, and rows of one id and
    text are one item. Document rows that share an id are documents of their own. Document ids are
    integers. An empty table on either side gives no rows.
    """
    at, key = 1, docs.schema[id_col].dataType
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("__item", T.LongType()), T.StructField(item_col, items.schema[item_col].dataType),
        T.StructField(id_col, T.LongType()), T.StructField("score", T.LongType())])
    out = None
    queries = items.select(item_col, item_text).distinct()
    for rows in _blocks(queries, item_col, item_text, block_chars):
        index = index_items(rows)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        n_docs, n_all, frequency = _statistics(narrow, at, shared)
        weight = weights(n_docs, frequency, len(index.number))

        def run(batches, shared=shared, weight=weight, n_docs=n_docs, n_all=n_all):
            index, best, held = shared.value, Best(len(shared.value.ids), k), []
            most = max(1, _CELLS // max(1, len(index.ids)))

            def flush():
                best.offer(score_slice([c for _, c in held], index, weight, n_docs, n_all), [i for i, _ in held])
                held.clear()

            for batch in batches:
                ids, done = batch.column(0).to_pylist(), 0
                for texts in text_slices(batch.column(at), _CHARS):
                    for text in texts:
                        n, found = _indexed(text, index.number)
                        if found:
                            held.append((ids[done], (n, found)))
                        done += 1
                        if len(held) >= most:
                            flush()
                    if held:
                        flush()
            found = list(best.rows())
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _, _ in found], pa.int64()), pa.array([index.ids[i] for i, _, _ in found], _arrow(schema[item_col].dataType)),
                pa.array([d for _, d, _ in found], pa.int64()), pa.array([s for _, _, s in found], pa.int64())], names=schema.names)

        heaps = in_batches(narrow, run, schema)
        by = Window.partitionBy("__item").orderBy(F.col("score").desc(), F.col(id_col).asc_nulls_last())
        ranked = heaps.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        ranked = ranked.select(item_col, "rank", F.col(id_col).cast(key).alias(id_col), "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def oracle() -> str:
    """DuckDB SQL for ``search(documents, benchmark)``."""
    found = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(
        string.ascii_uppercase, string.ascii_lowercase)
    return f"""
        WITH docs AS (SELECT doc_id, {found} AS found FROM documents),
        size AS (SELECT count(*) FILTER (len(found) > 0) AS n_docs, sum(len(found)) AS n_all FROM docs),
        counts AS (
            SELECT doc_id, n, term, count(*) AS tf
            FROM (SELECT doc_id, len(found) AS n, unnest(found) AS term FROM docs) GROUP BY doc_id, n, term),
        frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
        item_terms AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
        scored AS (
            SELECT item_id, doc_id,
                   sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                       * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all))))::BIGINT AS score
            FROM item_terms JOIN frequency USING (term) JOIN counts USING (term), size
            GROUP BY item_id, doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        WHERE rank <= {K}"""
