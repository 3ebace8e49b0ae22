"""Personal data: base rules, and spans added by a character-level BiLSTM-CRF (operator 6).

The tagger is trained in numpy from labelled spans. Texts are read in overlapping windows;
each window is decoded on its own, and a text's candidate spans from all its windows are
reconciled together: the set of non-overlapping spans of the greatest total confidence wins.
Spans of the base rules always stay; the tagger adds spans beside them: those the rules lose since
a neighbour is swallowed with them and the whole then fails (two card numbers side by side, a phone
number before another number). An added span is moved to the ends of the digit runs or address it
cuts and must then be a whole, valid value of its kind (``valid``), so a number that fails its
checksum or length is never added. For training, such pairs are made from the labelled spans.

Every span holds a digit or an @ (a rule of decoding), so windows without either have nothing
to decode and are passed over; that is exact and leaves about one window in a hundred of prose.

Scale: one pass over whole texts in Arrow batches, no shuffle; windows are decoded a few
hundred at a time. Training looks at a bounded sample: the windows, at most ``MAX_WINDOWS``,
of the ``SAMPLE_DOCS`` documents whose ids hash lowest.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import cut, in_batches
from relsync.llm.tagger import Tagger, encode
from relsync.llm.words import text_slices

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and from one window's start to the next.
WINDOW, STRIDE = 128, 64
#: Bounds of the training sample; windows made of two labelled spans side by side, beside it.
SAMPLE_DOCS, MAX_WINDOWS, PAIRED = 8000, 2000, 800
#: Mean probability of its tags that an added span needs, and its least number of characters.
CONFIDENCE, LEAST = 0.9, 7
#: Windows decoded, and bytes of text read, at a time (or one text, if longer).
_AT_ONCE, _BYTES = 512, 1 << 22

# The base rules' patterns. Digits after digits never start a match, so long
# runs of digits are read once; mail addresses are found from their @ for the same reason.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SEED = re.compile(r"[0-9@]")


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the base rules, by kind as in KINDS, then start. Null: none."""
    text = text or ""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


_WHOLE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "ip": _IP, "card": _CARD, "phone": _PHONE}


def valid(kind: str, value: str) -> bool:
    """Whether a text as a whole is a value of the kind, by the base rules' conditions."""
    if not _WHOLE[kind].fullmatch(value):
        return False
    return (kind, 0, len(value)) in base_spans(value)


def settle(kind: str, start: int, end: int, text: str) -> tuple[str, int, int] | None:
    """A tagged span moved out to the ends of the digit runs (of the address, for mail) that it cuts
    and in from characters a value cannot end with; None unless it is then valid."""
    inside = _LOCAL.__contains__ if kind == "email" else (lambda c: "0" <= c <= "9")
    plus = lambda c: kind == "phone" and c == "+"
    while start < end and not (inside(text[start]) or plus(text[start])):
        start += 1
    while start < end and not inside(text[end - 1]):
        end -= 1
    least, most = max(0, end - 4 * WINDOW), min(len(text), start + 4 * WINDOW)  # a longer run is no value
    while least < start < end and inside(text[start - 1]) and not plus(text[start]):
        start -= 1
    while start < end < most and inside(text[end]):
        end += 1
    if start > 0 and plus(text[start - 1]):
        start -= 1
    while start < end and text[end - 1] in "._%+":
        end -= 1
    return (kind, start, end) if valid(kind, text[start:end]) else None


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @, on the fixed grid of STRIDE."""
    out, last = [], max(0, -(-(len(text) - WINDOW) // STRIDE))
    done, at = -1, _SEED.search(text)
    while at:
        i = at.start()
        # windows w with w * STRIDE <= i < w * STRIDE + WINDOW
        for w in range(max(done + 1, (i - WINDOW) // STRIDE + 1, 0), min(last, i // STRIDE) + 1):
            out.append(w * STRIDE)
            done = w
        # the next seed that could open another window
        at = _SEED.search(text, max(i + 1, (done + 1) * STRIDE)) if done < last else None
    return out


def tag_window(start: int, length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """Tags of a window's characters from a text's spans; the earlier span wins an overlap."""
    tags = np.zeros(length, dtype=np.int64)
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2]), reverse=True):
        k = KINDS.index(kind)
        lo, hi = max(a - start, 0), min(b - start, length)
        if lo < hi:
            tags[lo:hi] = 2 * k + 2
            if a >= start:
                tags[lo] = 2 * k + 1
    # a span cut off by an earlier one goes on as a span of its own
    for i in range(1, length):
        if tags[i] and tags[i] % 2 == 0 and tags[i - 1] not in (tags[i], tags[i] - 1):
            tags[i] -= 1
    return tags


def fit_windows(windows: list[str], tags: list[np.ndarray], *, epochs: int = 12, hidden: int = 16) -> Tagger | None:
    """Train a tagger; without any labelled span there is none."""
    if not any(t.any() for t in tags):
        return None
    tagger = Tagger(len(KINDS), hidden)
    tagger.train(encode(windows, WINDOW), np.stack(tags), epochs=epochs)
    return tagger


def sample_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label=base_spans, sample_docs: int = SAMPLE_DOCS, max_windows: int = MAX_WINDOWS) -> list:
    """At most ``max_windows`` rows (w, tags, kinds) from a bounded sample of ``docs``: windows that
    hold a digit or an @, and one without from the head of a text. Of each kind as many labelled
    windows as there are, up to an even share of the bound; the rest by hash from all others, for
    contrast."""
    text = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = text.select("id").distinct().orderBy(F.xxhash64(F.lit(13), "id"), "id").limit(sample_docs)
    # at most sample_docs ids, which every task can hold
    sample = text.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            out = ([], [], [])
            for t in batch.column("text").to_pylist():
                spans, starts = label(t), window_starts(t)
                # one window of plain text for each text with something to find
                plain = [s for s in (0,) if starts and s not in starts]
                for s in starts + plain:
                    out[0].append(t[s:s + WINDOW])
                    tags = tag_window(s, WINDOW, [x for x in spans if x[1] < s + WINDOW and x[2] > s])
                    out[1].append(tags.astype(np.int8).tobytes())
                    out[2].append(np.unique((tags[tags > 0] - 1) // 2).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int32()))], names=["w", "tags", "kinds"])

    windows = cut(in_batches(sample, run, "w string, tags binary, kinds array<int>").distinct())
    order = (F.xxhash64(F.lit(17), "w"), "w", "tags")
    rows = {}
    for k in range(len(KINDS)):
        some = windows.where(F.array_contains("kinds", k)).orderBy(*order).limit(max_windows // (len(KINDS) + 1)).collect()
        rows |= {(r["w"], r["tags"]): r for r in some}
    for r in windows.orderBy(*order).limit(max_windows).collect():
        if len(rows) < max_windows:
            rows.setdefault((r["w"], r["tags"]), r)
    return list(rows.values())


def paired_windows(rows: list[tuple[str, np.ndarray]], most: int = PAIRED, seed: int = 19) -> list[tuple[str, np.ndarray]]:
    """Windows in which another labelled value follows a labelled one after a separator, as the rules
    lose them: made of (window, tags) rows, in turn over the kinds, at most ``most``."""
    whole: list[list[tuple[str, np.ndarray, int, int]]] = [[] for _ in KINDS]
    for w, tags in rows:
        for kind, a, b in _tag_spans(tags[:len(w)]):
            if valid(KINDS[kind], w[a:b]):
                whole[kind].append((w, tags, a, b))
    random, out = np.random.default_rng(seed), []
    some = [k for k, found in enumerate(whole) if found]
    for n in range(most if some else 0):
        k = some[n % len(some)]
        w, tags, a, b = whole[k][int(random.integers(len(whole[k])))]
        # mostly numbers of one kind meet; any two may
        k2 = k if random.random() < 0.5 else some[int(random.integers(len(some)))]
        v, _, c, d = whole[k2][int(random.integers(len(whole[k2])))]
        gap = (" ", " ", " ", "  ", " - ", ", ", "; ", " / ")[int(random.integers(8))]
        cut_ = int(random.integers(0, a + 1))  # what comes before the first value is shortened at random
        text = w[cut_:b] + gap + v[c:d] + w[b:]
        marks = np.concatenate([tags[cut_:b], np.zeros(len(gap), np.int64), [2 * k2 + 1], np.full(d - c - 1, 2 * k2 + 2), tags[b:len(w)]])
        marks = np.concatenate([marks, np.zeros(WINDOW, np.int64)])[:WINDOW]
        out.append((text[:WINDOW], marks))
    return out


def _tag_spans(tags: np.ndarray):
    """(kind, start, end) of the spans that tags mark; one that begins before the window is left out."""
    i, n = 0, len(tags)
    while i < n:
        j = i + 1
        if tags[i] % 2 == 1:
            while j < n and tags[j] == tags[i] + 1:
                j += 1
            yield int(tags[i] - 1) // 2, i, j
        i = j


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label=base_spans, sample_docs: int = SAMPLE_DOCS, max_windows: int = MAX_WINDOWS) -> Tagger | None:
    """Train on ``sample_windows`` of ``docs``, labelled by ``label`` (text -> spans). Repeated ids
    count once; null ids and texts are left out. Kinds without an example in the sample, and that
    no tagger could be trained for want of any, are told by a warning."""
    rows = sample_windows(docs, id_col=id_col, text_col=text_col, label=label, sample_docs=sample_docs, max_windows=max_windows)
    missing = [kind for k, kind in enumerate(KINDS) if not any(k in r["kinds"] for r in rows)]
    if len(missing) == len(KINDS):
        warnings.warn("personal data: no labelled window in the sample, no tagger trained, base spans only", stacklevel=2)
    elif missing:
        warnings.warn(f"personal data: no example of {', '.join(missing)} in the sample, the tagger adds none", stacklevel=2)
    pairs = [(r["w"], np.frombuffer(r["tags"], dtype=np.int8).astype(np.int64)) for r in rows]
    pairs += paired_windows(pairs)
    return fit_windows([w for w, _ in pairs], [t for _, t in pairs])


def _window_spans(tags: np.ndarray, prob: np.ndarray, start: int, window: str):
    """Candidates (kind, start, end, weight, confidence) of one decoded window."""
    size, i = len(window), 0
    while i < size:
        if tags[i] == 0:
            i += 1
            continue
        k, j = (tags[i] - 1) // 2, i + 1
        while j < size and tags[j] == 2 * k + 2:
            j += 1
        inside = prob[i:j, 2 * k + 1] + prob[i:j, 2 * k + 2]
        yield KINDS[k], start + i, start + j, float((inside - 0.5).sum()), float(inside.mean())
        i = j


def reconcile(candidates: list[tuple]) -> list[tuple]:
    """The non-overlapping candidates of the greatest total weight (weighted interval scheduling
    over the whole text; ties keep what was there)."""
    found = sorted({c for c in candidates if c[3] > 0}, key=lambda c: (c[2], c[1], c[0], c[3], c[4]))
    ends = [c[2] for c in found]
    total, take = [0.0], []
    for n, c in enumerate(found):
        before = bisect_right(ends, c[1], 0, n)
        take.append((total[before] + c[3] > total[n], before))
        total.append(max(total[n], total[before] + c[3]))
    out, n = [], len(found)
    while n:
        chosen, before = take[n - 1]
        if chosen:
            out.append(found[n - 1])
        n = before if chosen else n - 1
    return out[::-1]


def tagged_spans(texts: list[str | None], tagger: Tagger | None, confidence: float = CONFIDENCE) -> list[list[tuple[str, int, int]]]:
    """Reconciled spans of each text as the tagger sees them, in order."""
    candidates: list[list[tuple]] = [[] for _ in texts]
    if tagger is None:
        return candidates
    todo = [(i, s) for i, t in enumerate(texts) if t for s in window_starts(t)]
    for n in range(0, len(todo), _AT_ONCE):
        some = todo[n:n + _AT_ONCE]
        windows = [texts[i][s:s + WINDOW] for i, s in some]
        tags, prob = tagger.decode(encode(windows, WINDOW))
        for row, ((i, s), w) in enumerate(zip(some, windows, strict=True)):
            if tags[row].any():
                candidates[i] += _window_spans(tags[row], prob[row], s, w)
    out = []
    for text, cs in zip(texts, candidates, strict=True):
        spans = []
        for kind, a, b, _, sure in reconcile(cs):
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[b - 1].isspace():
                b -= 1
            if sure >= confidence and b - a >= LEAST and _SEED.search(text, a, b):
                spans.append((kind, a, b))
        out.append(spans)
    return out


def all_spans(texts: list[str | None], tagger: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, base and added spans) of each text, by kind, then start. A span of the tagger
    is added if it settles on a valid value and overlaps none of the base, nor one added before."""
    out = []
    for text, more in zip(texts, tagged_spans(texts, tagger), strict=True):
        base, add = base_spans(text), []
        for span in (settle(*s, text) for s in more):
            if span and not any(span[1] < b and a < span[2] for _, a, b in base + add):
                add.append(span)
        out.append((base, sorted(base + add, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


def _line(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, tagger: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone and base_sha256 (base
    spans: their numbers, and the digest of kind:start:end, comma-joined), and ``spans``, all
    spans joined likewise. Positions are code points, the end exclusive.

    Null and empty texts have no spans. Repeated rows each give a row, null ids are kept, an
    empty table gives an empty result; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        for batch in batches:
            found = [x for texts in text_slices(batch.column("text"), _BYTES) for x in all_spans(texts, shared.value)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(_line(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *counts, pa.array(digests, pa.string()), pa.array([_line(s) for _, s in found], pa.string())],
                names=[id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [T.StructField(id_col, rows.schema["id"].dataType), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS]]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return in_batches(rows, run, T.StructType(fields))


def mask(docs: DataFrame, tagger: Tagger | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in angle brackets, all columns and
    rows kept. Of overlapping spans the one that starts first (then the longer) is replaced. Null
    texts stay null, empty ones empty."""
    shared, at = docs.sparkSession.sparkContext.broadcast(tagger), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for texts in text_slices(batch.column(at), _BYTES):
                for text, (_, spans) in zip(texts, all_spans(texts, shared.value), strict=True):
                    parts, free = [], 0
                    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                        if a >= free:
                            parts += [text[free:a], f"<{k}>"]
                            free = b
                    out.append(text if text is None else "".join(parts) + text[free:])
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return in_batches(docs, run, docs.schema)
