"""Results that must be whole: neighbours of every length and of ids with many vectors, features
counted over all rows, and the gradient that training descends."""

import random

import numpy as np
import pytest
from helpers import documents, frame
from pyspark.sql import functions as F

from relsync.llm import neighbors, toxicity


def plain_neighbours(vectors, queries, k):
    """Every candidate of every query row, by the definition."""
    out = {}
    rows = {(i, tuple(v)) for i, v in vectors}
    for i, q in {(i, tuple(v)) for i, v in queries}:
        scored = sorted((-float(np.dot(q, v)), j) for j, v in rows if j != i and len(v) == len(q))
        out[i, q] = [(round(-s, 9), j) for s, j in scored[:k]]
    return out


def found_neighbours(spark, vectors, queries, k, **options):
    kind = "vec_id long, embedding array<double>"
    got = neighbors.nearest(spark.createDataFrame(vectors, kind), spark.createDataFrame(queries, kind), k=k, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((round(r["score"], 9), r["vec_id"]))
    return out


def test_every_length_is_searched_by_itself(spark):
    r = np.random.default_rng(3)
    vectors = [(i, r.standard_normal(n).tolist()) for n, ids in ((4, range(0, 60)), (6, range(100, 400)), (3, range(500, 505))) for i in ids]
    vectors += [(900, [1.0] * 9)]  # alone of its length
    queries = [v for v in vectors if v[0] % 20 == 0]
    want = plain_neighbours(vectors, queries, 10)
    got = found_neighbours(spark, vectors, queries, 10, cell=40, sample=200)
    found = total = 0
    for (i, q), best in want.items():
        assert len(got.get(i, [])) == len(best)
        found += len(set(best) & set(got.get(i, [])))
        total += len(best)
    assert found / total >= 0.9 and {i for i in got} == {i for i, _ in queries if i != 900}


def test_an_id_on_many_near_vectors_does_not_use_up_its_results(spark):
    r = np.random.default_rng(4)
    near = [(20, (np.array([9.0, 0.0, 0.0, 0.0]) + 0.01 * r.standard_normal(4)).tolist()) for _ in range(10)]
    vectors = near + [(i, r.standard_normal(4).tolist()) for i in range(100, 113)] + [(40, near[0][1])]
    queries = [near[0], near[1], (40, near[0][1])]
    want = plain_neighbours(vectors, queries, 5)
    got = found_neighbours(spark, vectors, queries, 5)
    both = sorted(want[20, tuple(near[0][1])] + want[20, tuple(near[1][1])])
    assert sorted(got[20]) == both and len(both) == 10
    assert got[40] == want[40, tuple(near[0][1])] and {i for _, i in got[40]} == {20}
    few = found_neighbours(spark, near + [(1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0, 0.0])], near[:1], 5)
    assert [i for _, i in few[20]] == [2, 1]  # all candidates


def test_one_id_on_a_third_of_all_rows(spark):
    r = np.random.default_rng(5)
    vectors = [(0 if i % 3 == 0 else i, r.standard_normal(8).tolist()) for i in range(900)]
    queries = [v for v in vectors if v[0] == 0][:15] + [v for v in vectors if v[0] and v[0] % 20 == 0]
    want = plain_neighbours(vectors, queries, 5)
    got = found_neighbours(spark, vectors, queries, 5, cell=100, sample=400)
    assert len(got[0]) == 75 and all(i != 0 for _, i in got[0])
    shared = sum(len(set(got[i]) & set(b)) for (i, _), b in want.items() if i) + len(set(got[0]) & {x for (i, _), b in want.items() if not i for x in b})
    assert shared / sum(map(len, want.values())) >= 0.9


# --- toxicity ------------------------------------------------------------------------------------
@pytest.mark.parametrize("prior, below", [(0.2, False), (0.9, True)])
def test_the_gradient_is_the_slope_of_the_risk(prior, below):
    r = np.random.default_rng(6)
    n_p, n_u, size = 30, 70, 12
    p_of, u_of = np.repeat(np.arange(n_p), 4), np.repeat(np.arange(n_u), 4)
    p_what, u_what = r.integers(0, size, 4 * n_p), r.integers(0, size, 4 * n_u)
    w = r.standard_normal(size + 1)
    if below:  # positives score high, all unlabelled text low
        p_what, u_what, w = p_what % 6, 6 + u_what % 6, np.where(np.arange(size + 1) < 6, 2.0, -1.0) + 0.1 * w
    args = (p_of, p_what, n_p, u_of, u_what, n_u, prior)

    def margins(of, what, n):
        return np.array([w[size] + sum(w[f] for o, f in zip(of, what) if o == d) for d in range(n)])

    s_p, s_u = (1 / (1 + np.exp(-margins(*x))) for x in ((p_of, p_what, n_p), (u_of, u_what, n_u)))
    unlabelled = s_u.mean() - prior * s_p.mean()
    assert (unlabelled < 0) == below
    value, slope = toxicity.risk(w, *args)
    assert value == pytest.approx(-unlabelled if below else prior * (1 - s_p).mean() + unlabelled)
    for i in range(size + 1):
        step = np.zeros(size + 1)
        step[i] = 1e-6
        by_difference = (toxicity.risk(w + step, *args)[0] - toxicity.risk(w - step, *args)[0]) / 2e-6
        assert slope[i] == pytest.approx(by_difference, abs=1e-8)


def test_features_are_counted_over_all_rows(spark):
    r = random.Random(7)
    rows = [d for d in documents(50) if d[1] is not None and len(d[1]) < 10_000]
    marked = [(t, r.randrange(9) if r.random() < 0.3 else None) for _, t, *_ in rows] * 3
    df = spark.createDataFrame(marked, "text string, toxic long").repartition(5)
    p, u, n_p, n_u = toxicity.feature_counts(df)
    sets = toxicity.feature_sets([t for t, _ in marked])
    want_u, want_p = np.zeros(1 << toxicity.BITS, np.int64), np.zeros(1 << toxicity.BITS, np.int64)
    for s, (_, y) in zip(sets, marked, strict=True):
        want_u[s] += 1
        want_p[s] += y is not None
    assert (u == want_u).all() and (p == want_p).all()
    assert (n_p, n_u) == (sum(y is not None for _, y in marked), len(marked))


def test_a_word_outside_the_sample_still_counts(spark):
    """Toxic words of documents that the optimiser's sample leaves out are learned from the counts."""
    rows = [(i, f"plain words number {i % 17} of an ordinary text", "en", "s", 0) for i in range(600)]
    rows = [(i, t + (f" zorgal{i % 3}" if i % 6 == 0 else ""), *rest) for i, t, *rest in rows]
    marks = spark.createDataFrame([(i, 0, int(i % 6 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(spark, rows), marks, max_positive=4, max_unlabelled=10)
    scored = {x["doc_id"]: x["predicted"] for x in toxicity.score(frame(spark, rows), model).collect()}
    assert len(model.features) > 0 and sum(scored[i] for i in range(0, 600, 6)) >= 60
    assert sum(v for i, v in scored.items() if i % 6) == 0
    none = toxicity.fit(frame(spark, rows).limit(0), marks)
    assert len(none.features) == 0
    assert toxicity.fit(frame(spark, rows), marks.where(F.lit(False))).features.size == 0
