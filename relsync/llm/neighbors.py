"""Approximate nearest neighbours by inner product (operator 4).

Vectors are given equal length by one more component (their inner products with a query keep
their order), so the largest inner product is the smallest distance. They are projected to a
few dimensions by a Gaussian, hence 2-stable, matrix: a projected distance is the true one
times a chi-square variable of that many degrees of freedom. The projections are indexed by a
kd-tree, its upper levels shared by all tasks, its lower ones built where the vectors lie. A
query takes its projected neighbours in order of distance and verifies them on the original
vectors, until the next one is so far that a vector as near as the k-th found would be
projected that far with a probability below ``1 - confidence`` only.

Scale: the upper tree is fitted on a bounded sample (``SAMPLE`` vectors) and every vector is
indexed. Equal vectors are one entry that carries its k + 1 smallest ids (more cannot
appear in any result), so a vector that a third of all rows hold is verified once, and equal
queries are searched once. Tree cells are cut into blocks of bounded size. A query visits
the cell nearest to its projection first, then the next few, then all that the stopping test
leaves open, so most of the tree is pruned by what the first rounds found. A task holds one
block and streams the queries sent there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import cut, lookup

#: Projected dimensions (even) and the confidence of the stopping test.
DIMS, CONFIDENCE = 10, 0.97
#: Vectors that the upper tree is fitted on; vectors per cell aimed at; most levels of it.
SAMPLE, CELL, LEVELS = 20_000, 4096, 12
#: Points of a lower tree's leaf.
LEAF = 64
#: Queries routed at a time, which bounds a table of their distances to all cells.
_ROUTED = 256
#: Cells visited in the first and second round; the third visits all that are left open.
ROUNDS = (1, 8)
SEED = 5


def chi_square_quantile(p: float, dims: int) -> float:
    """The value that a chi-square variable of an even number of dimensions exceeds with
    probability 1 - p: its tail is a Poisson sum, inverted by bisection."""
    def tail(x):
        term, total = math.exp(-x / 2), 0.0
        for i in range(dims // 2):
            total += term
            term *= x / 2 / (i + 1)
        return total

    low, high = 0.0, 1.0
    while tail(high) > 1 - p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > 1 - p else (low, mid)
    return high


def matrix(array: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of ``dim`` numbers each."""
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


class Space:
    """The projection: data vectors are lengthened to norm ``norm``, queries scaled to it."""

    def __init__(self, dim: int, norm: float, dims: int = DIMS, seed: int = SEED):
        self.dim, self.norm, self.dims = dim, norm, dims
        self.gauss = np.random.default_rng(seed).standard_normal((dim + 1, dims))

    def data(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return x @ self.gauss[:-1] + rest[:, None] * self.gauss[-1]

    def query(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.norm / np.sqrt((q * q).sum(axis=1)))[:, None]) @ self.gauss[:-1]


class UpperTree:
    """A kd-tree of ``levels`` levels: the widest dimension is split at its median."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels, n = levels, (1 << levels) - 1
        self.dim, self.at = np.zeros(n, dtype=np.int64), np.zeros(n)
        members = {0: points}
        for node in range(n):
            p = members.pop(node)
            if len(p):
                self.dim[node] = d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
                self.at[node] = np.median(p[:, d])
            right = p[:, self.dim[node]] >= self.at[node]
            if 2 * node + 1 < n:
                members[2 * node + 1], members[2 * node + 2] = p[~right], p[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[rows, self.dim[node]] >= self.at[node])
        return node - ((1 << self.levels) - 1)


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query point to each box."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        x = q[:, d:d + 1]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    return out


class Block:
    """A block's vectors under a lower kd-tree over their projections."""

    def __init__(self, vectors: np.ndarray, points: np.ndarray, ids: list[list[int]]):
        parts, order = [(0, len(points))], np.arange(len(points))
        done = []
        while parts:
            a, b = parts.pop()
            if b - a <= LEAF:
                done.append((a, b))
                continue
            p = points[order[a:b]]
            d, m = int(np.argmax(p.max(axis=0) - p.min(axis=0))), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(p[:, d], m)]
            parts += [(a, a + m), (a + m, b)]
        done.sort()
        self.vectors, self.points = vectors[order], points[order]
        self.ids = [ids[i] for i in order]
        self.only: dict[int, list[int]] | None = None
        self.start, self.end = np.array([a for a, _ in done]), np.array([b for _, b in done])
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in done])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in done])

    def without(self, rows: np.ndarray, own: int) -> np.ndarray:
        """The rows that hold another id than ``own``."""
        if self.only is None:
            self.only = {}
            for r, ids in enumerate(self.ids):
                if len(ids) == 1:
                    self.only.setdefault(ids[0], []).append(r)
        gone = self.only.get(own)
        return rows[~np.isin(rows, gone)] if gone else rows

    def search(self, q: np.ndarray, point: np.ndarray, k: int, norm: float, bound: float, reach: float, own: int | None = None):
        """The best k (score, id) found, ids other than ``own``: projected neighbours, leaf by leaf in
        order of distance, are verified until the next leaf is farther than ``reach`` times the squared
        distance of the k-th best. ``bound`` is that distance as known from elsewhere."""
        size = np.sqrt((q * q).sum())
        away = box_distance(point[None], self.low, self.high)[0]
        order = np.argsort(away, kind="stable")
        found: list[tuple[float, int]] = []
        at, step = 0, 2
        while at < len(order) and away[order[at]] <= reach * bound:
            some = order[at:at + step]
            some = some[away[some] <= reach * bound]
            rows = np.concatenate([np.arange(self.start[i], self.end[i]) for i in some])
            if own is not None:
                rows = self.without(rows, own)
            gap = self.points[rows] - point
            rows = rows[(gap * gap).sum(axis=1) <= reach * bound]
            score = (self.vectors[rows] * q).sum(axis=1)
            if len(rows) > k:
                # each vector brings an id at least: those below the k-th cannot be needed, ties can
                least = np.partition(score, len(score) - k)[len(score) - k]
                rows, score = rows[score >= least], score[score >= least]
            found += [(s, i) for s, r in zip(score.tolist(), rows.tolist(), strict=True) for i in self.ids[r] if i != own]
            found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
            if len(found) == k:
                bound = min(bound, _distance(found[-1][0], size, norm))
            at, step = at + step, 2 * step
        return found


def _distance(score: float, size: float, norm: float) -> float:
    """Squared distance, in the lengthened space, that belongs to a score; rounded up a little,
    so that rounding never hides a vector as near."""
    return max(0.0, 2 * norm * (norm - score / size)) + 1e-9 * norm * norm


def valid(df: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector takes part: no null or non-finite component, not zero, not null."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vec_col).isNotNull() & finite & F.exists(vec_col, lambda x: x != 0))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id", vec_col: str = "embedding",
    dims: int = DIMS, confidence: float = CONFIDENCE, cell: int = CELL, sample: int = SAMPLE, seed: int = SEED,
) -> DataFrame:
    """For each row of ``queries`` its ``k`` nearest rows of ``vectors`` (same columns id, vector)
    found, by largest inner product: query_id, rank (from 1), vec_id, score.

    Scores are inner products of the original vectors in double precision. Ties go to the
    smaller id. Rows of the query's own id are no candidates, however many vectors that id has.
    Null, zero and non-finite vectors and rows with a null id take no part. An inner product needs
    vectors of one length: every length is searched by itself. Rows equal in id and vector
    count once; an id with several vectors is a candidate, and a query, with each. With fewer than
    k candidates all are returned. Empty tables give an empty result; other columns play no part.
    """
    spark = vectors.sparkSession
    x = F.col(vec_col).cast("array<double>")
    rows = lambda df: valid(df.select(F.col(id_col).cast("long").alias("id"), x.alias("x")), "x").where("id IS NOT NULL")
    base, asked = rows(vectors), rows(queries)
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    shapes = base.groupBy(F.size("x").alias("dim")).agg(F.max(squares).alias("most"))
    wanted = asked.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for shape in shapes.join(wanted, "dim").orderBy("dim").collect():  # one row a length
        space = Space(shape["dim"], math.sqrt(shape["most"]), dims, seed)
        of_length = F.size("x") == shape["dim"]
        found = _nearest(base.where(of_length), asked.where(of_length), k, space, confidence, cell, sample)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _nearest(base: DataFrame, queries: DataFrame, k: int, space: Space, confidence: float, cell: int, sample: int) -> DataFrame:
    """``nearest`` for vectors ``x`` of one length."""
    spark = base.sparkSession
    dim, dims = space.dim, space.dims
    reach = chi_square_quantile(confidence, dims)
    need = k + 1  # the query's own row may be among them

    # equal vectors are one entry with their smallest ids
    same = Window.partitionBy("x").orderBy("id")
    few = base.distinct().withColumn("r", F.row_number().over(same)).where(F.col("r") <= need)
    entries = few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def project(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("ids"), lists(space.data(matrix(b.column("x"), dim)))], names=["x", "ids", "p"])

    entries = cut(entries.mapInArrow(project, "x array<double>, ids array<long>, p array<double>"))
    n = entries.count()
    levels = min(LEVELS, max(0, math.ceil(math.log2(max(1, n / cell)))))
    points = entries.select(F.xxhash64("x").alias("h"), "p").orderBy("h", "p").limit(sample).collect()
    tree = UpperTree(np.array([r["p"] for r in points], dtype=np.float64).reshape(-1, dims), levels)

    def celled(batches):
        for b in batches:
            c = tree.cell(matrix(b.column("p"), dims))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c)], names=[*b.schema.names, "cell"])

    entries = entries.mapInArrow(celled, T.StructType([*entries.schema.fields, T.StructField("cell", T.LongType())]))
    edge = [f(F.col("p")[i]).alias(f"{s}{i}") for i in range(dims) for s, f in (("low", F.min), ("high", F.max))]
    cells = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *edge).orderBy("cell").collect()
    # at most 2 ** LEVELS cells; a cell of many vectors is cut into blocks by hash
    low = np.array([[c[f"low{i}"] for i in range(dims)] for c in cells])
    high = np.array([[c[f"high{i}"] for i in range(dims)] for c in cells])
    blocks = [max(1, -(-c["n"] // (2 * cell))) for c in cells]
    first = np.concatenate(([0], np.cumsum(blocks))).astype(np.int64)
    numbers = spark.createDataFrame([(c["cell"], int(a), int(m)) for c, a, m in zip(cells, first, blocks, strict=False)], "cell long, first long, many int")
    stored = entries.join(F.broadcast(numbers), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("x"), F.col("many"))).alias("block"), F.lit(0).alias("side"),
        F.lit(None).cast("string").alias("key"), "x", "p", F.lit(None).cast("double").alias("bound"), F.lit(None).cast("long").alias("own"), "ids")

    key = F.md5(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"))
    # where a query's id has several vectors, the search itself leaves the id out; elsewhere equal
    # queries are searched once, and one place more makes up for the own row
    several = base.groupBy(F.col("id").alias("held")).agg(F.min(key).alias("least"), F.max(key).alias("most"))
    several = cut(several.where("least <> most").select("held"))
    asked = lookup(queries.distinct(), several, F.col("id") == F.col("held"), [F.xxhash64("x")], "left")
    named = F.when(F.col("held").isNull(), key).otherwise(F.concat_ws(":", key, "held"))
    asked = cut(asked.withColumn("key", named).withColumnRenamed("held", "own"))

    def project_queries(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("x"), lists(space.query(matrix(b.column("x"), dim))), b.column("own")], names=["key", "x", "p", "own"])

    searched = asked.groupBy("key").agg(F.first("x").alias("x"), F.first("own").alias("own"))
    searched = cut(searched.mapInArrow(project_queries, "key string, x array<double>, p array<double>, own long"))

    def route(lo, hi):
        def run(batches):
            for b in (x.slice(i, _ROUTED) for x in batches for i in range(0, x.num_rows, _ROUTED)):
                away = box_distance(matrix(b.column("p"), dims), low, high)
                order = np.argsort(away, axis=1, kind="stable")[:, lo:hi]
                bound = b.column("bound").to_numpy(zero_copy_only=False)
                open_ = np.take_along_axis(away, order, axis=1) <= reach * bound[:, None]
                q, c = np.nonzero(open_)
                c = order[q, c]
                many = np.asarray(blocks)[c]
                rows_ = np.repeat(q, many)
                block = np.repeat(first[c], many) + np.concatenate([np.arange(m) for m in many] or [np.zeros(0, np.int64)])
                for i in range(0, len(rows_), 4096):
                    some = b.take(pa.array(rows_[i:i + 4096]))
                    yield pa.RecordBatch.from_arrays([pa.array(block[i:i + 4096].astype(np.int64)), *some.columns], names=["block", *some.schema.names])
        return run

    def verify(batches):
        block, pending = None, []
        for b in batches:
            block_no = b.column("block").to_numpy()
            side = b.column("side").to_numpy()
            cuts_ = np.flatnonzero(np.diff(block_no) | np.diff(side)) + 1
            for a, z in zip([0, *cuts_.tolist()], [*cuts_.tolist(), b.num_rows], strict=True):
                if a == z:
                    continue
                part, number = b.slice(a, z - a), int(block_no[a])
                if side[a] == 0:
                    if block is None or block[0] != number or block[1] is not None:
                        block, pending = (number, None), []
                    pending.append((matrix(part.column("x"), dim), matrix(part.column("p"), dims), part.column("ids").to_pylist()))
                    continue
                if block is None or block[0] != number:
                    continue  # a block without vectors
                if block[1] is None:
                    block = (number, Block(np.concatenate([t[0] for t in pending]), np.concatenate([t[1] for t in pending]), [i for t in pending for i in t[2]]))
                    pending = []
                keys, out = part.column("key").to_pylist(), ([], [], [])
                each = zip(keys, matrix(part.column("x"), dim), matrix(part.column("p"), dims), part.column("bound").to_numpy(),
                           part.column("own").to_pylist(), strict=True)
                for name, q, p, bound, own in each:
                    for s, i in block[1].search(q, p, need, space.norm, bound, reach, own):
                        out[0].append(name), out[1].append(i), out[2].append(s)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["key", "id", "score"])

    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    top = None
    for lo, hi in zip((0, *ROUNDS), (*ROUNDS, None), strict=True):
        if lo >= len(cells):
            break
        if top is None:
            open_queries = searched.select("key", "x", "p", F.lit(float("inf")).alias("bound"), "own")
        else:
            # squared distance of the last needed result, none where there are fewer
            size = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
            last = top.where(F.col("r") == need).select(F.col("key").alias("of"), F.col("score").alias("least"))
            far = F.greatest(F.lit(0.0), 2 * space.norm * (space.norm - F.col("least") / size)) + 1e-9 * space.norm**2
            bound = F.when(F.col("least").isNull(), F.lit(float("inf"))).otherwise(far)
            open_queries = searched.join(last, F.col("key") == F.col("of"), "left").select("key", "x", "p", bound.alias("bound"), "own")
        sent = open_queries.mapInArrow(route(lo, hi), "block long, key string, x array<double>, p array<double>, bound double, own long")
        sent = sent.select("block", F.lit(1).alias("side"), "key", "x", "p", "bound", "own", F.lit(None).cast("array<long>").alias("ids"))
        met = stored.unionByName(sent).repartition("block").sortWithinPartitions("block", "side")
        found = met.mapInArrow(verify, "key string, id long, score double")
        if top is not None:
            found = found.unionByName(top.select("key", "id", "score"))
        top = cut(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= need))

    own = asked.select(F.col("id").alias("query_id"), F.col("key").alias("of"))
    pairs = own.join(top, F.col("of") == F.col("key")).where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
