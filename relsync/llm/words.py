"""Vectorised word hashing of text batches in numpy, shared by the Arrow-batched operators.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters of the
lower-cased text. Its hash depends on its bytes only, so equal words hash alike in every
batch, process and run.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Characters hashed at a time. Bounds memory only: longer texts are hashed in pieces.
PIECE = 1 << 18

_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _word_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[ord("0"):ord("9") + 1] = True
    table[ord("a"):ord("z") + 1] = True
    table[0x80:] = True
    return table


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64; n a power of two."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, b & _MASK, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (fixed constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(texts: list[str]):
    """(text number, piece) with pieces of about PIECE characters that end at a word's end."""
    for i, text in enumerate(texts):
        text = text.lower()
        if len(text) <= PIECE:
            yield i, text
            continue
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            # never cut a word: move on to the next character that ends one
            while end < len(text) and (ord(text[end]) > 127 or text[end].isalnum()):
                end += 1
            yield i, text[at:end]
            at = end


def hashed_pieces(texts: list[str | None], prefixes: tuple[int, ...] = ()):
    """Word hashes of all texts, a bounded number of characters at a time: yields, in order, the
    hashes, the text number of each word, and for every requested prefix length (in bytes)
    the hashes of the words' prefixes. A word shorter than a prefix length has hash 0 there.
    Null texts count as empty."""
    batch, numbers, size = [], [], 0

    def hashed():
        parts = [p.encode("utf-8", "surrogatepass") for p in batch]
        data = np.frombuffer(b" ".join(parts), dtype=np.uint8)
        word = _word_bytes()[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
        start, end = edge[0::2], edge[1::2]
        ends = np.cumsum([len(p) + 1 for p in parts])
        owner = np.asarray(numbers, dtype=np.int64)[np.searchsorted(ends, start, side="right")]
        n = 1 << max(10, int(len(data)).bit_length())
        power, inverse = _powers(n)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)))
        back = inverse[start]
        hashes = mix((total[end] - total[start]) * back + (end - start).astype(np.uint64))
        heads = []
        for k in prefixes:
            long = end - start >= k
            h = mix((total[np.where(long, start + k, end)] - total[start]) * back + np.uint64(k << 32))
            heads.append(np.where(long, h, np.uint64(0)))
        return hashes, owner, heads

    for i, piece in _pieces([t or "" for t in texts]):
        batch.append(piece)
        numbers.append(i)
        size += len(piece) + 1
        if size >= PIECE:
            yield hashed()
            batch, numbers, size = [], [], 0
    if batch:
        yield hashed()


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the text number of each word."""
    parts = [(h, o) for h, o, _ in hashed_pieces(texts)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in parts]), np.concatenate([o for _, o in parts])


def text_slices(column, most: int):
    """An Arrow text column as lists of texts, ``most`` characters' worth of bytes at a time."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > most:
            yield column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += n
    if start < len(size):
        yield column.slice(start).to_pylist()


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words (all of them as one run, if fewer than k)."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + words[j:j + n]
    return mix(out)
