"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt over shards by a hash of their id; each shard builds a
vantage-point tree: a node keeps the ranges of distances from its vantage point
to the inner and the outer half of its points. By the triangle inequality a
half whose range lies further than t from a query's own distance holds nothing
nearer than t. A half is skipped if that bound exceeds ``factor`` times the
distance of the k-th best so far: factor 1 is exact search, smaller factors
look at fewer nodes and may miss neighbours. Every vector is indexed. The
shards' k best per query meet in one partial top-k.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, take no part; rows that repeat an id count
once (the greatest vector); only vectors of a query's own dimension are its
candidates; equal distances go to the smaller id; with fewer than k candidates
all are returned; an empty table gives no rows; extra columns are ignored.

Scale: queries go to the shards in blocks of QUERY_BLOCK, so a task holds one
shard (about SHARD_ROWS vectors) and one block of queries; both are hashed
evenly whatever vectors repeat.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import materialize, python_tasks, table

SHARD_ROWS = 4096
QUERY_BLOCK = 1024
LEAF = 64
NONE = np.iinfo(np.int64).max
SLACK = 1e-9  # rounding of the bounds, relative


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(((queries[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))


class VantagePointTree:
    """Nodes: (vantage point, inner, inner range, outer, outer range) or an array of rows."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.visited = 0
        self.root = self._node(np.arange(len(ids)), np.random.default_rng(7))

    def _node(self, rows: np.ndarray, rng: np.random.Generator):
        if len(rows) <= LEAF:
            return np.sort(rows)
        vantage = self.points[rng.choice(rows)]
        d = distances(vantage[None, :], self.points[rows])[0]
        by = np.argsort(d, kind="stable")
        half = len(rows) // 2  # by rank, so equal points split too
        inner, outer = by[:half], by[half:]
        return (vantage, self._node(rows[inner], rng), (d[inner[0]], d[inner[-1]]),
                self._node(rows[outer], rng), (d[outer[0]], d[outer[-1]]))

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the k nearest of each query, other than the query's own id."""
        self.best = np.full((len(qids), k), np.inf)
        self.best_id = np.full((len(qids), k), NONE)
        self.qids, self.queries, self.factor = qids, queries, factor
        if len(qids) and len(self.ids):
            self._visit(self.root, np.arange(len(qids)))
        return self.best, self.best_id

    def _visit(self, node, at: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            self._scan(node, at)
            return
        vantage, inner, (a1, b1), outer, (a2, b2) = node
        d = distances(self.queries[at], vantage[None, :])[:, 0]
        bounds = (np.maximum(np.maximum(a1 - d, d - b1), 0), np.maximum(np.maximum(a2 - d, d - b2), 0))
        near_inner = bounds[0] <= bounds[1]
        for first, mask in ((0, near_inner), (1, ~near_inner)):
            if mask.any():
                for side in (first, 1 - first):
                    limit = self.factor * self.best[at, -1]
                    go = mask & (bounds[side] * (1 - SLACK) <= limit)
                    if go.any():
                        self._visit((inner, outer)[side], at[go])

    def _scan(self, rows: np.ndarray, at: np.ndarray) -> None:
        self.visited += len(rows) * len(at)
        d = distances(self.queries[at], self.points[rows])
        ids = np.broadcast_to(self.ids[rows], d.shape).copy()
        own = ids == self.qids[at][:, None]
        d[own], ids[own] = np.inf, NONE
        d, ids = np.hstack([self.best[at], d]), np.hstack([self.best_id[at], ids])
        k = self.best.shape[1]
        for key in (lambda: ids, lambda: d):  # by id, then stably by distance
            order = np.argsort(key(), axis=1, kind="stable")
            d, ids = np.take_along_axis(d, order, 1), np.take_along_axis(ids, order, 1)
        self.best[at], self.best_id[at] = d[:, :k], ids[:, :k]


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles): the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & v.isNotNull()).where((F.size(v) > 0) & ~bad)
    rows = rows.where(F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.groupBy("vec_id").agg(F.max("v").alias("v"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0) -> DataFrame:
    """query_id, rank, vec_id, score for (vec_id, v) frames of candidates and queries."""
    python_tasks(vectors.sparkSession)
    n, nq = vectors.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(nq / QUERY_BLOCK))
    deal = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = vectors.select(F.size("v").alias("dim"), deal("vec_id", shards).alias("shard"), each(blocks).alias("block"),
                          "vec_id", "v")
    right = queries.select(F.size("v").alias("dim"), each(shards).alias("shard"), deal("vec_id", blocks).alias("block"),
                           "vec_id", "v")

    def task(key: tuple, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(points) and len(asked):
            tree = VantagePointTree(points["vec_id"].to_numpy("int64"), np.stack(points["v"].to_list()))
            qids = asked["vec_id"].to_numpy("int64")
            d, ids = tree.search(qids, np.stack(asked["v"].to_list()), k, factor)
            real = ids != NONE
            out = {"query_id": np.repeat(qids, real.sum(axis=1)), "vec_id": ids[real], "score": d[real]}
        return pd.DataFrame(out)
    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        task, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(usable(table(spark, sf_dir, "embeddings")), "vp-vectors")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, factor=1.0)


SQL = """
WITH e AS (SELECT vec_id, max(embedding::DOUBLE[]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_distance(q.v, c.v) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
