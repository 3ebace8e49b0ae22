"""The decontamination index: bounded memory, few pairs, and no leak lost."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from helpers import frame, prose

from relsync.llm import decontaminate
from relsync.llm.decontaminate import index_items, make_item, rare_shingles, scan_texts


def plain_leaks(text, item, k=5):
    """Best similarity of any window of the item's size, and where."""
    w, q = text.split(), item.split()
    k = min(k, len(q))

    def shingles(words):
        return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))

    want, best = shingles(q), (0.0, 0)
    for a in range(max(1, len(w) - len(q) + 1)):
        have = shingles(w[a:a + len(q)])
        both, either = sum((have & want).values()), sum((have | want).values())
        if either and both / either > best[0]:
            best = (both / either, a)
    return best


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95, 1.0])
def test_rare_shingles_lose_no_leak(similarity):
    r = random.Random(int(similarity * 100))
    shared = prose(15, 2)
    items = [" ".join([shared, prose(r.randint(3, 50), i)]) for i in range(25)] + [prose(r.randint(1, 8), 90 + i) for i in range(6)]
    items += [items[0], " ".join(["echo"] * 30), " ".join(["echo"] * 24)]
    texts = ["", shared, prose(300, 1)]
    for item in items:
        words = item.split()
        texts.append(prose(r.randint(0, 20), r.random()) + " " + item + " " + prose(r.randint(0, 30), r.random()))
        for _ in range(3):  # changed, cut and extended copies around the threshold
            w = list(words)
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = "other"
            texts.append(" ".join(w[r.randint(0, 2):len(w) - r.randint(0, max(0, len(w) // 6))]))
    rare = rare_shingles(index_items([make_item(i, t) for i, t in enumerate(items)]), similarity)
    # a radius of all bits: the fingerprints then leave nothing out, so any loss would be the shingles'
    found = scan_texts(texts, rare, similarity, 64)
    got = {(d, x[0], x[1], round(x[4], 9)) for d, leaks in enumerate(found) for x in leaks}
    want = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            s, at = plain_leaks(text, item)
            if s and s >= similarity:
                want.add((d, i, at, round(s, 9)))
    assert got == want and len(want) > 25


def test_many_items_with_shared_shingles_stay_in_bounded_memory():
    """50,000 items that share half of their text, and documents full of what they share."""
    shared = prose(14, 1)
    items = [make_item(i, f"{shared} " + " ".join(f"u{i}x{j}" for j in range(10))) for i in range(50_000)]
    tracemalloc.start()
    rare = rare_shingles(index_items(items))
    texts = [" ".join([shared] * 20 + [prose(40, i)]) for i in range(100)]
    texts += [f"{prose(30, i)} {shared} " + " ".join(f"u{i}x{j}" for j in range(10)) for i in range(0, 50_000, 5_000)]
    found = scan_texts(texts, rare, 0.8, 22)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[x[0] for x in leaks] for leaks in found] == [[]] * 100 + [[i] for i in range(0, 50_000, 5_000)]
    assert peak < 200 << 20


def test_items_that_share_their_rare_shingles_are_compared_in_slices(monkeypatch):
    monkeypatch.setattr(decontaminate, "_PAIRS", 50)
    shared = prose(36, 1)
    texts = [f"{prose(5, 2)} {shared} {prose(5, 3)}"] * 2
    items = [f"{shared} w{i % 7}" for i in range(60)]
    found = scan_texts(texts, rare_shingles(index_items([make_item(i, t) for i, t in enumerate(items)])), 0.8, 22)
    assert [sorted(x[0] for x in leaks) for leaks in found] == [list(range(60))] * 2
    seen = np.array([i for i in range(300)], dtype=np.uint64)
    index = index_items([make_item(i, prose(9, i)) for i in range(40)])[0]
    w, i = decontaminate.candidates(seen, index, 22)
    want = {(a, b) for a in range(300) for b in range(40) if int(np.bitwise_count(seen[a] ^ index.fingerprints[b])) <= 22}
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == want


def test_few_pairs_are_examined(monkeypatch):
    """Of all pairs of a window and an item of its size, the shared rare shingles leave a small part."""
    seen = []
    real = decontaminate.within
    monkeypatch.setattr(decontaminate, "within", lambda a, b, radius: seen.append(len(a)) or real(a, b, radius))
    items = [prose(40, 100 + i) for i in range(500)]
    texts = [prose(400, 5_000 + i) for i in range(40)] + [f"{prose(100, i)} {items[i]} {prose(100, i + 50)}" for i in range(10)]
    found = scan_texts(texts, rare_shingles(index_items([make_item(i, t) for i, t in enumerate(items)])), 0.8, 22)
    assert [[x[0] for x in leaks] for leaks in found[40:]] == [[i] for i in range(10)]
    windows = sum(len(t.split()) - 39 for t in texts)
    assert sum(seen) < 0.001 * windows * len(items)


def test_blocks_by_items(spark):
    items = [(i, prose(20, i)) for i in range(30)] + [(30, prose(20, 3)), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(i, f"{prose(9, 70 + i)} {prose(20, i)}", "en", "s", 0) for i in range(30)])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, block_items=7).collect()}
    assert got == {(i, i) for i in range(30)} | {(3, 30)}
