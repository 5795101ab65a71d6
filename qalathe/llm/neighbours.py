"""Approximate nearest neighbours by inner product over stable projections and kd-trees.

An extra component makes all vectors equally long, so the largest inner product is the smallest
Euclidean distance. Gaussian projections to few dimensions keep distances in distribution: the
squared projected distance over the true one is chi-square. A kd-tree over the projections, its
upper levels fitted on a bounded sample, deals all vectors into cells. A query takes the cells, and
in a cell the leaves, in the order of their projected distance and verifies what they hold on the
original vectors. It stops where a vector as near as its present k-th would have been met already
with the wanted confidence.

Defined cases. Vectors that are null, empty or zero, or hold a null or a number that is not
finite, take no part; neither do those of another length than the most frequent one (the longest
of several). Equal vectors are searched for once, and of those found the smallest ids are enough,
since ties go to smaller ids. A query is never its own neighbour. Fewer candidates than k give as
many rows. Null ids take no part; rows repeating an id with one vector count once. Other columns do
not matter. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import forget, saved

DIMENSIONS = 8  # even, for the chi-square distribution in closed form
CONFIDENCE = 0.95
SAMPLE = 20_000
CELL_ROWS = 4096
LEAF_ROWS = 128
QUERIES_PER_TASK = 2048
SEED = 11


def chi_square_quantile(p: float, dof: int) -> float:
    """The value that a chi-square variable of an even number of degrees stays below with chance ``p``."""
    def below(x: float) -> float:
        term = total = 1.0
        for k in range(1, dof // 2):
            term *= x / 2 / k
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Projection:
    """Gaussian projections of vectors made equally long; queries have 0 as the extra component."""

    def __init__(self, length: int, longest: float, dims: int) -> None:
        self.matrix = np.random.default_rng(SEED).standard_normal((length + 1, dims))
        self.longest = longest

    def points(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))
        return x @ self.matrix[:-1] + extra[:, None] * self.matrix[-1]

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1]


class KdTree:
    """Median splits of the widest dimension, level by level; leaves are numbered from left to right."""

    def __init__(self, points: np.ndarray, depth: int) -> None:
        self.depth, dims = depth, points.shape[1]
        self.axis, self.value = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        self.low, self.high = np.full((1 << depth, dims), -np.inf), np.full((1 << depth, dims), np.inf)
        at = np.zeros(len(points), np.int64)
        for level in range(depth):
            for node in range(1 << level):
                own = points[at == node]
                axis = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
                value = float(np.median(own[:, axis])) if len(own) else 0.0
                self.axis[(1 << level) + node], self.value[(1 << level) + node] = axis, value
                span = 1 << (depth - level)
                half = node * span + span // 2
                self.high[node * span:half, axis] = np.minimum(self.high[node * span:half, axis], value)
                self.low[half:(node + 1) * span, axis] = np.maximum(self.low[half:(node + 1) * span, axis], value)
            at = self._step(points, at, level)

    def _step(self, points: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        node = (1 << level) + at
        return 2 * at + (points[np.arange(len(points)), self.axis[node]] > self.value[node])

    def leaf(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for level in range(self.depth):
            at = self._step(points, at, level)
        return at

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to the box of each leaf."""
        out = np.zeros((len(points), len(self.low)))
        for k in range(points.shape[1]):
            x = points[:, k:k + 1]
            out += np.maximum(np.maximum(self.low[:, k] - x, x - self.high[:, k]), 0) ** 2
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def search(
    ids: np.ndarray, x: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int,
    projection: Projection, quantile: float,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (places, scores) of its k best in ``x``; ``bounds`` are k-th scores known before.

    Leaves are opened in the order of their projected distance, all queries at once; a query
    drops out when its next leaf lies beyond the distance that the chi-square test allows.
    """
    projected = projection.points(x)
    tree = KdTree(projected, max(0, math.ceil(math.log2(max(len(x), 1) / LEAF_ROWS))))
    leaf = tree.leaf(projected)
    members = [np.flatnonzero(leaf == b) for b in range(1 << tree.depth)]
    apart = tree.distances(projection.queries(queries))
    order = np.argsort(apart, axis=1, kind="stable")
    base = (queries * queries).sum(1) + projection.longest**2
    n = len(queries)
    top, place = np.full((n, k), -np.inf), np.full((n, k), -1)
    active = np.arange(n)
    for step in range(order.shape[1]):
        nearest = order[active, step]
        kth = np.maximum(top[active, -1], bounds[active])
        reach = quantile * np.maximum(base[active] - 2 * kth, 0)
        go = apart[active, nearest] <= reach
        active, nearest = active[go], nearest[go]
        if not len(active):
            break
        for b in np.unique(nearest):
            some, own = active[nearest == b], members[b]
            if not len(own):
                continue
            scores = np.concatenate([top[some], queries[some] @ x[own].T], axis=1)
            places = np.concatenate([place[some], np.broadcast_to(own, (len(some), len(own)))], axis=1)
            best = np.lexsort((np.where(places < 0, np.iinfo(np.int64).max, ids[places]), -scores), axis=1)[:, :k]
            top[some] = np.take_along_axis(scores, best, 1)
            place[some] = np.take_along_axis(places, best, 1)
    out = []
    for q in range(n):
        found = place[q][place[q] >= 0]
        # Each score again in one way of summing, so that equal vectors have equal scores.
        scores = (x[found] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[found], -scores))
        out.append((found[best], scores[best]))
    return out


# --- tables -------------------------------------------------------------------------------

def _valid(table: DataFrame, vector: str, vec_id: str) -> DataFrame:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return table.select(F.col(vec_id).cast("long").alias("id"), x.cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0))


def _searched(cells: DataFrame, asked: DataFrame, k: int, projection: Projection, quantile: float) -> DataFrame:
    """(qid, qvec, ids, scores) of the searches ``asked`` (cell, qid, qvec, bound).

    The queries of a cell are dealt over tasks by their number; the list of cells is bounded.
    """
    counts = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    parts = F.broadcast(counts.select("cell", F.ceil(F.col("n") / QUERIES_PER_TASK).cast("int").alias("parts")))
    left = cells.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = asked.join(parts, "cell").withColumn(
        "part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int")).drop("parts")

    def found(points: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("qid", pa.int64()), ("qvec", pa.list_(pa.float64())),
                            ("ids", pa.list_(pa.list_(pa.int64()))), ("scores", pa.list_(pa.float64()))])
        if not queries.num_rows or not points.num_rows:
            return schema.empty_table()
        ids = points.column("ids").combine_chunks().to_pylist()
        first = np.array([i[0] for i in ids])
        rows = search(first, _matrix(points.column("vec")), _matrix(queries.column("qvec")),
                      queries.column("bound").to_numpy(), k, projection, quantile)
        return pa.table([queries.column("qid").combine_chunks(), queries.column("qvec").combine_chunks(),
                         [[ids[p] for p in places] for places, _ in rows], [s.tolist() for _, s in rows]], schema=schema)

    return left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInArrow(
        found, "qid long, qvec array<double>, ids array<array<long>>, scores array<double>")


def nearest(
    candidates: DataFrame, queries: DataFrame, k: int = 20, vector: str = "embedding", vec_id: str = "vec_id",
    dims: int = DIMENSIONS, confidence: float = CONFIDENCE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of the largest inner product found for each query.

    Both tables have ids and vectors; a query is known among the candidates by its id.
    """
    spark = candidates.sparkSession
    valid = _valid(candidates, vector, vec_id).distinct()
    lengths = valid.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d"))
    usual = lengths.first()  # one row
    length = usual["d"] if usual else 1
    # Of equal vectors the k + 1 smallest ids; the window is limited on the map side.
    by_vector = Window.partitionBy("vec").orderBy("id")
    points = saved(
        valid.where(F.size("vec") == length).withColumn("nth", F.row_number().over(by_vector))
        .where(F.col("nth") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    n, longest = points.agg(F.count(F.lit(1)), F.coalesce(F.sqrt(F.max(square)), F.lit(0.0))).first()
    projection, quantile = Projection(length, longest, dims), chi_square_quantile(confidence, dims)
    sample = points.orderBy(F.xxhash64("vec")).limit(SAMPLE).select("vec").toArrow()
    depth = max(0, math.ceil(math.log2(max(min(n / CELL_ROWS, SAMPLE / 16), 1))))
    tree = KdTree(projection.points(_matrix(sample.column(0))) if n else np.zeros((0, dims)), depth)

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = _matrix(part.column("vec"))
            cell = tree.leaf(projection.points(x)) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *part.columns], ["cell", *part.schema.names])

    cells = saved(points.mapInArrow(dealt, "cell long, vec array<double>, ids array<long>"), "cells")
    asking = saved(_valid(queries, vector, vec_id).where(F.size("vec") == length).distinct(), "queries")
    distinct = saved(asking.groupBy("vec").agg(F.min("id").alias("qid")), "distinct-queries")

    def at_home(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = _matrix(part.column("vec"))
            cell = tree.leaf(projection.queries(x)) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), part.column("qid"), part.column("vec"), pa.array(np.full(len(x), -np.inf))],
                ["cell", "qid", "qvec", "bound"])

    asked = "cell long, qid long, qvec array<double>, bound double"
    first = saved(_searched(cells, distinct.mapInArrow(at_home, asked), k + 1, projection, quantile), "first")

    def elsewhere(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = _matrix(part.column("vec"))
            if not len(x):
                continue
            at = projection.queries(x)
            scores = part.column("scores").to_pylist()
            bound = np.array([s[k] if s is not None and len(s) > k else -np.inf for s in scores])
            reach = quantile * ((x * x).sum(1) + longest**2 - 2 * bound)
            near = tree.distances(at) <= reach[:, None]
            near[np.arange(len(x)), tree.leaf(at)] = False
            q, cell = np.nonzero(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), *(part.column(c).take(pa.array(q)) for c in ("qid", "vec")), pa.array(bound[q])],
                ["cell", "qid", "qvec", "bound"])

    beyond = distinct.join(first.select("qid", "scores"), "qid", "left").mapInArrow(elsewhere, asked)
    second = saved(_searched(cells, saved(beyond, "beyond"), k + 1, projection, quantile), "second")
    found = first.unionByName(second).select("qid", F.explode(F.arrays_zip("ids", "scores")).alias("f")).select(
        "qid", F.explode("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    kept = saved(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth"), "found")
    forget(points, cells, first, second)
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(distinct, "vec").select(F.col("id").alias("query_id"), "qid").join(kept, "qid")
        .where(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
