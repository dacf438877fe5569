"""Approximate nearest neighbours by collision-counting hashing with query-centred windows.

Every hash function is one random projection. A slice of the vectors keeps, for each projection, its vectors sorted by
their projected value. A query centres a window on its own projection in each sorted array and widens all windows in step:
virtual rehashing, so one set of arrays serves every radius. A vector collides with the query once for each window that
holds it; the vectors that collide in at least ``THRESHOLD`` of the projections are verified by their exact distance. The
windows of a query stop growing when their half width is ``REACH`` times the distance of its k-th nearest vector found in
the slice: a nearer vector then lies in a single window with probability 0.68, so it passes the threshold almost surely.

Each slice holds at most about ``SLICE`` vectors and answers for itself; the best k of all slices are the result, and a
slice gives at most k rows a query. Queries are broadcast in blocks of about ``BLOCK``, each a pass over the vectors, so
memory does not grow with either side. The windows have no cap on their content: many equal vectors all collide, all are
verified, and ties go to the smaller ids.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do rows
without an id. A query is not its own candidate; of several rows with one id the nearest counts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rosterkeep.llm.common import groups_for, pick, stored

PROJECTIONS = 48
THRESHOLD = 0.5
REACH = 1.0
GROWTH = 1.5
SLICE = 10_000
BLOCK = 2048

_ROWS = "query_id long, vec_id long, score double"


class Slice:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.projections = projections
        values = projections @ vectors.T
        self.order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(values, self.order, axis=1)

    def nearest(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, ties to smaller ids; the query's own id is left out."""
        n = len(self.ids)
        enough = int(np.ceil(THRESHOLD * len(self.projections)))
        centre = self.projections @ query
        low = high = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centre, strict=True)])
        counts = np.zeros(n, np.int32)
        counts_done = np.zeros(n, bool)
        ids, distances = np.zeros(0, np.int64), np.zeros(0)
        half = self._first_width(centre, low, k)
        while True:
            lower = np.array([np.searchsorted(v, c - half, "left") for v, c in zip(self.values, centre, strict=True)])
            upper = np.array([np.searchsorted(v, c + half, "right") for v, c in zip(self.values, centre, strict=True)])
            # Only what the windows took in since the last width is counted.
            new = [self.order[j, a:b] for j in range(len(low)) for a, b in ((lower[j], low[j]), (high[j], upper[j])) if a < b]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            low, high = np.minimum(lower, low), np.maximum(upper, high)
            fresh = np.flatnonzero((counts >= enough) & ~counts_done)
            counts_done[fresh] = True
            fresh = fresh[self.ids[fresh] != own_id]
            if len(fresh):
                difference = self.vectors[fresh] - query
                ids, distances = _best(
                    np.concatenate((ids, self.ids[fresh])),
                    np.concatenate((distances, np.sqrt(np.einsum("ij,ij->i", difference, difference)))),
                    k,
                )
            everything = (low == 0).all() and (high == n).all()
            if everything or (len(ids) >= k and half >= REACH * distances[-1]):
                return ids, distances
            half = min(half * GROWTH, REACH * distances[-1]) if len(ids) >= k else half * GROWTH

    def _first_width(self, centre: np.ndarray, place: np.ndarray, k: int) -> float:
        """A width at which a typical window holds a few times k vectors."""
        n = len(self.ids)
        step = min(n - 1, 8 * k)
        a, b = np.clip(place - step, 0, n - 1), np.clip(place + step, 0, n - 1)
        rows = np.arange(len(place))
        width = np.median(np.maximum(np.abs(self.values[rows, a] - centre), np.abs(self.values[rows, b] - centre)))
        return float(width) if width > 0 else float(np.finfo(float).tiny)


def _best(ids: np.ndarray, distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest, ties to smaller ids, each id once."""
    order = np.lexsort((ids, distances))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:k]
    return ids[order], distances[order]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part."""
    rows = pick(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("embedding", lambda x: x != 0))


def _answers(asked, projections: np.ndarray, k: int):
    def answer(group: pa.Table) -> pa.Table:
        """The best of one slice for every query of a block."""
        vectors = np.array(group["embedding"].combine_chunks().flatten()).reshape(-1, projections.shape[1])
        index = Slice(group["vec_id"].to_numpy(), vectors, projections)
        ids, best, distances = [], [], []
        for query_id, query in asked.value:
            near, far = index.nearest(query_id, query, k)
            ids.append(np.full(len(near), query_id)), best.append(near), distances.append(far)
        columns = [np.concatenate(x) if x else np.zeros(0) for x in (ids, best, distances)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    return answer


def search(vectors: DataFrame, is_query, k: int = 10, seed: int = 1) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean distance) of the k nearest found of each query.

    ``is_query`` tells by ``vec_id`` which rows are queries; every row is a candidate.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = sizes[0]["d"]
    rows = rows.where(F.size("embedding") == d)
    projections = np.random.default_rng(seed).normal(size=(PROJECTIONS, d))
    # The slice of a row depends on its values only: a task that runs again gets the same vectors.
    n_slices = groups_for(rows.count(), SLICE)
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(n_slices)))
    queries = rows.where(is_query(F.col("vec_id")))
    n_blocks = groups_for(queries.count(), BLOCK)

    found = None
    for block in range(n_blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(n_blocks)) == block).collect()
        asked = spark.sparkContext.broadcast([(r["vec_id"], np.array(r["embedding"])) for r in own])
        part = sliced.groupBy("slice").applyInArrow(_answers(asked, projections, k), _ROWS)
        part = stored(part, "neighbours") if n_blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
