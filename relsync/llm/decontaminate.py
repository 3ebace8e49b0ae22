"""Benchmark decontamination (operator 2).

A document leaks a benchmark item if some window of as many words as the item has (the whole
document, if it has fewer) has a weighted similarity of 0.8 or more to it: the multisets of
their five-word shingles, sum of smaller counts over sum of greater counts.

Windows are fingerprinted by SimHash over their weighted shingles. A fingerprint is split
into eight blocks; two fingerprints within ``radius`` bits have a block in which they differ
by at most ``radius // 8`` bits. Window and item go on if some block is that close and then
all 64 bits are within the radius; the exact similarity decides.

At the radius that a similarity of 0.8 needs, blocks alone let most random pairs through (two
bits of eight: 71 %), so which windows meet which items is narrowed before, without loss: a window
as similar as that holds all but ``1 - similarity`` of an item's shingles, hence one at least of
its rarest ones, one more than that share. Only those shingles are looked up, and only the windows
around a hit are compared with the items that hold it. Pairs are taken in slices of bounded size.

The radius is a parameter of the search: at a similarity of 0.8 about 10 of 64 bits are expected
to differ, with a deviation of 3; 22 misses hardly one in 20,000.

Scale: one pass over the documents in Arrow batches, no shuffle, memory bounded by a batch,
its longest text's word hashes and a slice of pairs. The benchmark is the stated query set: it is
split by hash into blocks of a bounded number of characters and items, each broadcast for a pass
of its own, so it may grow. Items of equal shingles are compared once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import in_batches, without
from relsync.llm.words import hashed_words, shingle_hashes, text_slices

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 22
#: Characters and items of the benchmark that one pass takes along.
BLOCK_CHARS, BLOCK_ITEMS = 16_000_000, 100_000
#: Windows fingerprinted, and bytes of text scanned (or one text, if longer), at a time.
_AT_ONCE, _CHARS = 1 << 14, 1 << 21
#: Pairs of a window and an item compared at a time.
_PAIRS = 1 << 19


@dataclass(frozen=True)
class Item:
    """A benchmark item: its id, words, and shingles as sorted distinct hashes with counts."""

    item_id: object
    words: int
    shingles: np.ndarray
    counts: np.ndarray
    fingerprint: int


@dataclass(frozen=True)
class SizeIndex:
    """Items of one number of words; ``ids`` are the benchmark ids of each (equal items are one)."""

    words: int
    k: int
    items: list[Item]
    fingerprints: np.ndarray
    ids: list[list]


@dataclass(frozen=True)
class Rare:
    """The rarest shingles of all items of one shingle length, sorted, and for each the items that
    hold it (``holders[offsets[s]:offsets[s + 1]]``), numbered through the ``indexes``."""

    k: int
    indexes: list[SizeIndex]
    first: np.ndarray  # number of each index's first item
    known: np.ndarray
    offsets: np.ndarray
    holders: np.ndarray


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows hashes[s:s + size], for sorted distinct ``starts``."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for i in range(0, len(starts), _AT_ONCE):
        some = starts[i:i + _AT_ONCE]
        # lay the windows' positions side by side, without the gaps between them
        need = np.zeros(int(some[-1] - some[0]) + size + 1, dtype=np.int32)
        np.add.at(need, some - some[0], 1)
        np.add.at(need, some - some[0] + size, -1)
        used = np.cumsum(need)[:-1] > 0
        place = np.cumsum(used) - 1
        bits = np.unpackbits(hashes[some[0]:some[0] + len(used)][used].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.zeros((len(bits) + 1, 64), dtype=np.int32)
        np.cumsum(bits, axis=0, out=total[1:], dtype=np.int32)
        at = place[some - some[0]]
        ones = total[at + size] - total[at]
        out[i:i + len(some)] = np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def make_item(item_id: object, text: str | None, shingle: int = SHINGLE) -> Item | None:
    words, _ = hashed_words([text])
    if not len(words):
        return None
    hashes = shingle_hashes(words, shingle)
    found, counts = np.unique(hashes, return_counts=True)
    fp = window_fingerprints(hashes, np.zeros(1, dtype=np.int64), len(hashes))[0]
    return Item(item_id, len(words), found, counts, int(fp))


def index_items(items: list[Item], radius: int = RADIUS, shingle: int = SHINGLE) -> list[SizeIndex]:
    """Items by number of words."""
    out = []
    for words in sorted({i.words for i in items}):
        equal: dict[tuple, list[Item]] = {}
        for i in items:
            if i.words == words:
                equal.setdefault((i.fingerprint, i.shingles.tobytes(), i.counts.tobytes()), []).append(i)
        own = [group[0] for group in equal.values()]
        fps = np.array([i.fingerprint for i in own], dtype=np.uint64)
        out.append(SizeIndex(words, min(words, shingle), own, fps, [[i.item_id for i in group] for group in equal.values()]))
    return out


def rare_shingles(indexes: list[SizeIndex], similarity: float = SIMILARITY) -> list[Rare]:
    """For each shingle length, of every item so many of its rarest shingles (by the number of items
    that hold them) that a window without any of them cannot reach the similarity.

    An item of n shingles and a window of m share at most m, and s (n + m) / (1 + s) at least when
    the similarity is s; so m is s n or more, and n (1 - s) at most of the item's are not shared.
    """
    out = []
    for k in sorted({x.k for x in indexes}):
        group = [x for x in indexes if x.k == k]
        items = [i for x in group for i in x.items]
        known, held = np.unique(np.concatenate([i.shingles for i in items]), return_counts=True)
        place, holder = [], []
        for n, item in enumerate(items):
            at = np.searchsorted(known, item.shingles)
            order = np.argsort(held[at], kind="stable")
            total = int(item.counts.sum())
            enough = np.searchsorted(np.cumsum(item.counts[order]), int(total * (1 - similarity) + 1e-9) + 1)
            place.append(at[order[:enough + 1]])
            holder.append(np.full(len(place[-1]), n))
        place, holder = np.concatenate(place), np.concatenate(holder)
        used, which = np.unique(place, return_inverse=True)
        order = np.argsort(which, kind="stable")
        offsets = np.searchsorted(which[order], np.arange(len(used) + 1))
        first = np.concatenate(([0], np.cumsum([len(x.items) for x in group])))
        out.append(Rare(k, group, first, known[used], offsets, holder[order]))
    return out


def within(fps: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs of fingerprints are within the radius: those with a close block are measured."""
    apart = fps ^ others
    blocks = np.bitwise_count(apart.astype("<u8").view(np.uint8).reshape(-1, 8))
    close = np.flatnonzero((blocks <= radius // 8).any(axis=1))
    return close[np.bitwise_count(apart[close]) <= radius]


def candidates(fps: np.ndarray, index: SizeIndex, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, item number) of all pairs of an index within the radius, a slice of windows
    at a time."""
    n, w, i = max(1, len(index.items)), [], []
    for a in range(0, len(fps), max(1, _PAIRS // n)):
        some = fps[a:a + max(1, _PAIRS // n)]
        found = within(np.repeat(some, n), np.tile(index.fingerprints, len(some)), radius)
        w.append(a + found // n)
        i.append(found % n)
    return np.concatenate(w or [np.zeros(0, np.int64)]), np.concatenate(i or [np.zeros(0, np.int64)])


def weighted_similarity(window: np.ndarray, item: Item) -> float:
    """Sum of smaller counts over sum of greater counts of two multisets of shingles."""
    at = np.searchsorted(item.shingles, window)
    at[at == len(item.shingles)] = 0
    at = at[item.shingles[at] == window]
    both = np.minimum(np.bincount(at, minlength=len(item.shingles)), item.counts).sum()
    return float(both / (len(window) + item.counts.sum() - both))


def _hits(words: np.ndarray, owner: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the shingles, inside one text each, that are in ``known`` (sorted), and where."""
    if len(words) < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = shingle_hashes(words, k)
    # a coarse bit table first: most shingles are no item's
    coarse = np.zeros(1 << 20, dtype=bool)
    coarse[(known >> np.uint64(44)).astype(np.int64)] = True
    hit = np.flatnonzero(coarse[(hashes >> np.uint64(44)).astype(np.int64)] & (owner[: len(hashes)] == owner[k - 1:]))
    at = np.searchsorted(known, hashes[hit])
    at[at == len(known)] = 0
    real = known[at] == hashes[hit]
    return hit[real], at[real]


def _slices(counts: np.ndarray, most: int):
    """(a, b) ranges of rows whose counts sum up to ``most`` or less, or of one row."""
    reached, a = np.cumsum(counts), 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(reached, (reached[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _spread(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., counts[0] numbers, then those of the next row."""
    return np.repeat(start - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


def scan_texts(texts: list[str | None], rare: list[Rare], similarity: float, radius: int) -> list[list[tuple]]:
    """Leaks of each text: (item_id, start_word, words, hamming, similarity), the best window of
    each item (ties: the earliest), in order of the items' sizes."""
    words, owner = hashed_words(texts)
    best: list[dict[tuple, tuple]] = [{} for _ in texts]
    for r in rare:
        holding = owner[_hits(words, owner, r.k, r.known)[0]]
        if not len(holding):
            continue
        # from here on only the texts that hold some item's rare shingle
        some = np.isin(owner, holding)
        own, hashes = owner[some], shingle_hashes(words[some], r.k)
        hit, which = _hits(words[some], own, r.k, r.known)
        held = r.offsets[which + 1] - r.offsets[which]
        for a, b in _slices(held, _PAIRS):
            item = r.holders[_spread(r.offsets[which[a:b]], held[a:b])]
            at = np.repeat(hit[a:b], held[a:b])
            _windows(best, hashes, own, r, item, at, similarity, radius)
    out: list[list[tuple]] = []
    for found in best:
        rows = []
        for (words_, _, _), (index, n, start, size, bits, s) in sorted(found.items(), key=lambda x: x[0]):
            rows += [(item_id, start, size, bits, s) for item_id in index.ids[n]]
        out.append(rows)
    return out


def _windows(best, hashes, own, r: Rare, item: np.ndarray, at: np.ndarray, similarity: float, radius: int) -> None:
    """Compare every item with the windows of its size around its hits (the whole text, if shorter)."""
    of = np.searchsorted(r.first, item, "right") - 1
    size = np.array([x.words for x in r.indexes])[of] - r.k + 1
    # shingle positions first .. last are those of the hit's text
    first, last = np.searchsorted(own, own[at], "left"), np.searchsorted(own, own[at], "right") - r.k
    short = last - first + 1 < size
    for s, n, a, b in sorted(set(zip(of[short].tolist(), item[short].tolist(), first[short].tolist(), last[short].tolist(), strict=True))):
        fp = window_fingerprints(hashes, np.array([a]), b - a + 1)
        _judge(best, hashes, own, r.indexes[s], s, np.array([a]), fp, np.array([n - r.first[s]]), b - a + 1, similarity, radius)
    low, high = np.maximum(first, at - size + 1), np.minimum(at, last - size + 1)
    for s in np.unique(of[~short]).tolist():
        mine = np.flatnonzero(~short & (of == s))
        mine = mine[np.lexsort((low[mine], item[mine]))]
        n, a, b = item[mine] - r.first[s], low[mine], high[mine]
        # the windows of an item around neighbouring hits overlap: each is compared once. Sorted by
        # start, and of one size, they also end in order
        again = np.concatenate(([False], n[1:] == n[:-1]))
        a = np.where(again, np.maximum(a, np.concatenate(([0], b[:-1])) + 1), a)
        n, a, b = n[a <= b], a[a <= b], b[a <= b]
        mark = np.zeros(len(hashes) + 1, dtype=np.int32)
        np.add.at(mark, a, 1)
        np.add.at(mark, b + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
        size_ = r.indexes[s].words - r.k + 1
        fps = window_fingerprints(hashes, starts, size_)
        for x, y in _slices(b - a + 1, _PAIRS):
            counts = b[x:y] - a[x:y] + 1
            start = _spread(a[x:y], counts)
            w = np.searchsorted(starts, start)
            _judge(best, hashes, own, r.indexes[s], s, start, fps[w], np.repeat(n[x:y], counts), size_, similarity, radius)


def _judge(best, hashes, own, index: SizeIndex, number: int, starts, fps, items, size: int, similarity: float, radius: int) -> None:
    """Keep the best window of each item, of pairs of a window and an item within the radius."""
    for p in within(fps, index.fingerprints[items], radius).tolist():
        n, at = int(items[p]), int(starts[p])
        s = weighted_similarity(hashes[at:at + size], index.items[n])
        if s < similarity:
            continue
        d = int(own[at])
        start = at - int(np.searchsorted(own, d, "left"))
        key = (index.words, number, n)
        if key not in best[d] or (s, -start) > (best[d][key][5], -best[d][key][2]):
            bits = (int(fps[p]) ^ index.items[n].fingerprint).bit_count()
            best[d][key] = (index, n, start, size + index.k - 1, bits, s)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int, block_items: int) -> list[list[tuple]]:
    """The benchmark's rows in blocks of about ``block_chars`` characters and ``block_items`` items."""
    size = benchmark.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars"), F.count(F.lit(1)).alias("items")).first()
    n = max(1, -(-size["chars"] // block_chars), -(-size["items"] // block_items))
    block = F.pmod(F.xxhash64(text_col, item_col), F.lit(n))
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"), block.alias("block"))
    for b in range(n):
        # a block's size is bounded by its expected number of characters; items are short texts
        yield [(r["item"], r["text"]) for r in rows.where(F.col("block") == b).orderBy("item", "text").collect()]


def annotate(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, block_chars: int = BLOCK_CHARS, block_items: int = BLOCK_ITEMS,
    name: str = "leaks",
) -> DataFrame:
    """``docs``, all rows and columns, with ``name``: an array of the benchmark items that the text
    leaks (item_id, start_word, n_words, hamming, similarity; the best window of each item).

    Words are lower-cased runs of letters, digits and non-ASCII characters. Null, empty and
    wordless texts leak nothing, and such items match nothing. An item of fewer words than a
    shingle is one shingle of its own length. Repeated items are each reported; item ids may
    be null. A column ``name`` is replaced. An empty benchmark gives empty arrays.
    """
    docs = without(docs, name)
    at = docs.columns.index(text_col)
    leak = T.StructType([
        T.StructField("item_id", benchmark.schema[item_col].dataType), T.StructField("start_word", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()), T.StructField("hamming", T.IntegerType()), T.StructField("similarity", T.DoubleType()),
    ])
    names = [f.name for f in leak]
    out = None
    for rows in _blocks(benchmark, item_col, item_text, block_chars, block_items):
        items = [x for x in (make_item(i, t, shingle) for i, t in rows) if x]
        shared = docs.sparkSession.sparkContext.broadcast(rare_shingles(index_items(items, radius, shingle), similarity))
        again = out is not None

        def run(batches, shared=shared, again=again):
            kind = None
            for batch in batches:
                found = [
                    [dict(zip(names, x, strict=True)) for x in leaks]
                    for texts in text_slices(batch.column(at), _CHARS) for leaks in scan_texts(texts, shared.value, similarity, radius)
                ]
                columns, before = batch.columns, None
                if again:
                    columns, before = batch.columns[:-1], batch.columns[-1].to_pylist()
                    found = [a + b for a, b in zip(before, found, strict=True)]
                kind = kind or pa.list_(pa.struct([("item_id", _arrow(leak["item_id"].dataType)), ("start_word", pa.int32()), ("n_words", pa.int32()), ("hamming", pa.int32()), ("similarity", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*batch.schema.names[: len(columns)], name])

        schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(leak))])
        out = in_batches(out if again else docs, run, schema)
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document row and item it leaks: id, item_id, start_word, n_words, hamming,
    similarity. See ``annotate`` for the options and for what null and short texts do."""
    found = annotate(docs.select(id_col, text_col), benchmark, text_col=text_col, name="leaks", **options)
    return found.select(id_col, F.inline("leaks"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, all columns kept."""
    found = annotate(docs, benchmark, text_col=text_col, name="__leaks", **options)
    return found.where(F.size("__leaks") == 0).drop("__leaks")
