"""Toxicity by non-negative positive-unlabelled learning (operator 10).

A document is the set of its hashed words and word beginnings. Classifiers are trained in
numpy from confirmed toxic documents (positives) and unlabelled text, a mixture in which the
share of toxic documents, the class prior, is known from the labels. The risk of calling
unlabelled text clean is corrected by the prior times the risk of calling positives clean;
where that estimate goes below zero, which only overfitting brings about, the step goes back
up (non-negative risk estimator). The score is the sigmoid of the classifiers' mean margin.

Scale: which features stand out in toxic text is decided by counts over all training documents
(one pass, summed per feature in tasks before one small shuffle; at most ``1 << BITS`` features, so
the driver's table is bounded). The optimiser looks at a bounded sample (``max_positive`` and
``max_unlabelled`` documents, those whose ids hash lowest), of which tasks send the standing-out
features only. Scoring is one pass over whole texts in Arrow batches, without a shuffle; texts are
hashed in bounded pieces, and only features that carry weight are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import cut, in_batches, lookup, without
from relsync.llm.words import hashed_pieces, text_slices

#: Feature space: the upper bits of a feature's hash.
BITS = 20
#: Word beginnings that are features, by length in bytes.
PREFIXES = (3, 4, 5, 6)
#: Bounds of the optimiser's sample, in documents.
MAX_POSITIVE, MAX_UNLABELLED = 10_000, 20_000
FOLDS = 5
#: What features need to count: standard errors above the rate in unlabelled text, and times
#: the rate in clean text.
SURE, TIMES = 2.5, 4.0
#: Bytes of text whose features are gathered at a time (or one text, if longer).
_BYTES = 1 << 21


@dataclass(frozen=True)
class Model:
    """Linear classifiers on hashed features; ``weights`` has a row per kept feature."""

    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    prior: float


def _features(texts: list[str | None]):
    """(text number, feature) of all word occurrences, a bounded piece of text at a time."""
    shift = np.uint64(64 - BITS)
    for words, owner, heads in hashed_pieces(texts, PREFIXES):
        for h in (words, *heads):
            real = h != 0
            yield owner[real], (h[real] >> shift).astype(np.int64)


def feature_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct features of each text, sorted."""
    found = [np.unique(of << BITS | what) for of, what in _features(texts)]
    once = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    ends = np.searchsorted(once >> BITS, np.arange(len(texts) + 1))
    what = (once & ((1 << BITS) - 1)).astype("<i4")
    return [what[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def risk(w, p_of, p_what, n_p, u_of, u_what, n_u, prior) -> tuple[float, np.ndarray]:
    """The quantity a step descends and its gradient, for weights and bias (last) ``w``.

    With sigmoid loss, s(x) the sigmoid of a margin: the unlabelled risk is mean s(u) - prior mean
    s(p). Where it is 0 or more the non-negative risk estimate is prior mean (1 - s(p)) plus it;
    below 0 the step goes up on it instead, so what descends is its negative.
    """
    size = len(w) - 1
    s_p = _sigmoid(w[size] + np.bincount(p_of, w[p_what], n_p))
    s_u = _sigmoid(w[size] + np.bincount(u_of, w[u_what], n_u))
    d_p, d_u = s_p * (1 - s_p) / n_p, s_u * (1 - s_u) / n_u
    unlabelled = s_u.mean() - prior * s_p.mean()
    if unlabelled >= 0:
        value, c_p, c_u = prior * (1 - s_p.mean()) + unlabelled, -2 * prior * d_p, d_u
    else:
        value, c_p, c_u = -unlabelled, prior * d_p, -d_u
    g = np.bincount(p_what, c_p[p_of], size + 1) + np.bincount(u_what, c_u[u_of], size + 1)
    g[size] = c_p.sum() + c_u.sum()
    return float(value), g


def _train(p_of, p_what, n_p, u_of, u_what, n_u, start, prior, rounds, step, shrink):
    """Weights and bias (last) of one classifier, from ``start``: full-batch Adam on the
    non-negative risk with sigmoid loss, weights shrunk towards zero after each step."""
    w, size = start.copy(), len(start) - 1
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        _, g = risk(w, p_of, p_what, n_p, u_of, u_what, n_u, prior)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        now = step * (1 - 0.9 * t / rounds)
        w -= now * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w[:size] = np.sign(w[:size]) * np.maximum(np.abs(w[:size]) - shrink, 0)
    return w[:size], w[size]


def standing_out(p_n: np.ndarray, u_n: np.ndarray, n_p: int, n_u: int, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Features that count and the weights (bias last) that training starts from, by the number of
    positive and unlabelled documents that hold each feature.

    A feature must be in 3 positives at least, more frequent there by SURE standard errors, and TIMES
    as frequent as in clean text, whose share is the unlabelled one less the prior's part. Weights
    start at half the logarithm of that ratio, since the sigmoid loss is not convex.
    """
    mean = (p_n + u_n) / (n_p + n_u)
    error = np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n_p + 1 / n_u))
    clean = np.maximum(u_n / n_u - prior * p_n / n_p, 0) / (1 - prior)
    kept = np.flatnonzero((p_n >= 3) & ((p_n / n_p - u_n / n_u) > SURE * error) & (p_n / n_p >= TIMES * clean))
    ratio = (p_n[kept] / n_p + 1e-4) / (clean[kept] + 2 / n_u)
    return kept, np.append(0.5 * np.clip(np.log(ratio), 0, 4), -2.0)


def _without_examples(prior: float) -> Model:
    """Scores every text 0.05."""
    return Model(np.zeros(0, np.int64), np.zeros((0, 1)), np.array([np.log(0.05 / 0.95)]), prior)


def train_arrays(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], kept: np.ndarray, start: np.ndarray, prior: float, *,
    classifiers: int = 3, rounds: int = 300, step: float = 0.05, shrink: float = 0.001, seed: int = 11,
) -> Model:
    """Train on feature sets (one array of distinct features per document) from ``standing_out``. Each
    classifier sees all positives and another random two thirds of the unlabelled documents."""
    flat = lambda xs: (np.repeat(np.arange(len(xs), dtype=np.int32), [len(x) for x in xs]), np.concatenate(xs))
    (p_of, p_what), (u_of, u_what), n_p, n_u = flat(positive), flat(unlabelled), len(positive), len(unlabelled)
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))

    def only(of, what):
        at = place[what]
        return of[at >= 0], at[at >= 0]

    p_of, p_what = only(p_of, p_what)
    u_of, u_what = only(u_of, u_what)
    random, weights, bias = np.random.default_rng(seed), [], []
    for _ in range(classifiers):
        some = np.sort(random.permutation(n_u)[: max(1, 2 * n_u // 3)])
        number = np.full(n_u, -1)
        number[some] = np.arange(len(some))
        mine = number[u_of] >= 0
        w, b = _train(p_of, p_what, n_p, number[u_of[mine]], u_what[mine], len(some), start, prior, rounds, step, shrink)
        weights.append(w)
        bias.append(b)
    weights = np.array(weights).T.reshape(len(kept), classifiers)
    used = np.flatnonzero((weights != 0).any(axis=1))
    return Model(kept[used], weights[used], np.array(bias), prior)


def fit_arrays(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, **options) -> Model:
    """``train_arrays`` with the features that stand out in these same documents. Without positives
    or unlabelled documents the model scores every text 0.05."""
    if not positive or not unlabelled:
        return _without_examples(prior)
    p_n, u_n = (np.bincount(np.concatenate(x), minlength=1 << BITS) for x in (positive, unlabelled))
    kept, start = standing_out(p_n, u_n, len(positive), len(unlabelled), prior)
    return train_arrays(positive, unlabelled, kept, start, prior, **options)


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Score of each text, between 0 and 1."""
    place = np.full(1 << BITS, -1, dtype=np.int64)
    place[model.features] = np.arange(len(model.features))
    n, found = max(1, len(model.features)), []
    for of, what in _features(texts):
        at = place[what]
        found.append(np.unique(of[at >= 0] * n + at[at >= 0]))
    once = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    margin = np.zeros(len(texts))
    if len(once):
        margin += np.bincount(once // n, model.weights.mean(axis=1)[once % n], len(texts))
    return _sigmoid(margin + model.bias.mean())


def _score_column(column, model: Model) -> np.ndarray:
    return np.concatenate([score_texts(t, model) for t in text_slices(column, _BYTES)] or [np.zeros(0)])


def held_out(id_col: Column) -> Column:
    """Whether an id is kept from training: CRC-32 of the id as text, modulo 5, is 0. Null: no."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None, seed: int = 11,
) -> Model:
    """Train on the documents whose ids are not held out.

    Positives are documents with a label 1 (a document with several labels counts as toxic if
    one says so); unlabelled text is any document, whatever its label. The prior is the share
    of label 1 among labelled ids unless given; other labels play no part. Null ids, texts
    and labels are left out of training. Rows that share an id are counted each when features are
    chosen, and are one document in the sample.
    """
    spark = docs.sparkSession
    train = lambda c: c.isNotNull() & ~held_out(c)
    judged = labels.where(train(F.col(id_col)) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    judged = judged.agg(F.max(F.col(label_col).cast("int")).alias("y"))
    if prior is None:
        n = judged.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0)).alias("p")).first()
        prior = n["p"] / n["n"] if n["n"] else 0.0
    prior = min(max(prior, 1e-4), 0.9)
    text = docs.where(train(F.col(id_col)) & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    toxic = cut(judged.where("y = 1").select(F.col("id").alias("toxic")))
    p_n, u_n, n_p, n_u = feature_counts(lookup(text, toxic, F.col("id") == F.col("toxic"), [F.xxhash64("text")], "left"))
    if not n_p or not n_u:
        return _without_examples(prior)
    kept, start = standing_out(p_n, u_n, n_p, n_u, prior)

    order = [F.xxhash64(F.lit(seed), "id"), "id"]
    ids = text.select("id").distinct()
    some_p = ids.join(toxic, F.col("id") == F.col("toxic"), "left_semi").orderBy(*order).limit(max_positive)
    some_u = ids.orderBy(*order).limit(max_unlabelled)
    chosen = some_p.withColumn("p", F.lit(1)).unionByName(some_u.withColumn("p", F.lit(0))).groupBy("id").agg(
        F.max("p").alias("p"), F.max(1 - F.col("p")).alias("u"))
    # at most max_positive + max_unlabelled ids: a bound that every task can hold
    sample = text.join(F.broadcast(chosen), "id")

    def run(batches):
        for batch in batches:
            sets = [np.intersect1d(x, kept, True).astype("<i4").tobytes() for texts in text_slices(batch.column("text"), _BYTES) for x in feature_sets(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("p"), batch.column("u"), pa.array(sets, pa.binary())], names=["id", "p", "u", "features"])

    kind = T.StructType([*sample.select("id", "p", "u").schema.fields, T.StructField("features", T.BinaryType())])
    # repeated ids are reduced to one in tasks, so the driver gets the bounded sample only
    rows = in_batches(sample.select("id", "p", "u", "text"), run, kind).groupBy("id", "p", "u").agg(F.min("features").alias("features"))
    rows = sorted(rows.collect(), key=lambda r: r["id"])
    read = lambda side: [np.frombuffer(r["features"], "<i4") for r in rows if r[side]]
    return train_arrays(read("p"), read("u"), kept, start, prior, seed=seed)


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Over all rows of (text, toxic: null where not confirmed): how many toxic and how many of all
    rows hold each feature, and how many toxic and how many rows there are."""
    total = 1 << BITS

    def run(batches):
        p, u = np.zeros(total + 1, dtype=np.int64), np.zeros(total + 1, dtype=np.int64)
        for batch in batches:
            toxic = np.asarray(batch.column("toxic").is_valid())
            done = 0
            for texts in text_slices(batch.column("text"), _BYTES):
                sets = feature_sets(texts)
                mine = toxic[done:done + len(texts)]
                done += len(texts)
                u += np.bincount(np.concatenate(sets), minlength=total + 1)
                p += np.bincount(np.concatenate([x for x, t in zip(sets, mine, strict=True) if t] or [np.zeros(0, np.int64)]), minlength=total + 1)
                u[total] += len(texts)
                p[total] += int(mine.sum())
        held = np.flatnonzero(u)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(p[held]), pa.array(u[held])], names=["feature", "p", "u"])

    counts = in_batches(rows.select("text", "toxic"), run, "feature long, p long, u long")
    # at most 1 << BITS features and the totals
    found = counts.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).toArrow()
    p_n, u_n = np.zeros(total + 1, dtype=np.int64), np.zeros(total + 1, dtype=np.int64)
    at = found.column("feature").to_numpy()
    p_n[at], u_n[at] = found.column("p").to_numpy(), found.column("u").to_numpy()
    return p_n[:total], u_n[:total], int(p_n[total]), int(u_n[total])


def score(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs``, all rows and columns (the text only with ``keep_text``), with ``score`` (double, 0
    to 1) and ``predicted`` (1 if the score reaches ``threshold``). Null and empty texts get the
    score of a text without words. Columns of these names are replaced."""
    spark = docs.sparkSession
    docs = without(docs, "score", "predicted")
    at, shared = docs.columns.index(text_col), spark.sparkContext.broadcast(model)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]

    def run(batches):
        for batch in batches:
            s = _score_column(batch.column(at), shared.value)
            more = [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            names = [*(batch.schema.names[i] for i in kept), "score", "predicted"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *more], names=names)

    kind = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return in_batches(docs, run, T.StructType([*(docs.schema.fields[i] for i in kept), *kind]))


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score below ``threshold``, all columns kept."""
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keep = _score_column(batch.column(at), shared.value) < threshold
            yield batch.filter(pa.array(keep))

    return in_batches(docs, run, docs.schema)
