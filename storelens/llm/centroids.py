"""Centroid clustering: Lloyd's rounds with an exact nearest-centroid search in a vantage-point tree.

Vectors become integer vectors, so distances, sums and means are exact and every
run gives the same result.  Each round builds a vantage-point tree over the
centroids on the driver and broadcasts it; tasks search it for their vectors and
add up, per cluster, what the new centroids need; the sums of k centroids are all
that reaches the driver.

The search is best-first branch and bound with a frontier per vector: each vector
opens the node of its own frontier that can hold the nearest centroid, until no
node is left whose lower bound is within its best distance.  That radius is
inclusive (and widened by far more than the rounding of a square root), so
centroids at equal distance are all seen and the smaller number wins.  The
vectors of a batch take their steps together: those that open the same node meet
its centroids in one exact matrix product.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import column

CLUSTERS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SEED = "2"
LEAF = 6                             # centroids of a leaf
MAX_CELLS = 1 << 24                  # clusters x components, the bound of driver and broadcast
EXACT_DOUBLE = 1 << 53
LARGEST = 1 << 62                    # squared distances stay below
_FRONTIER = 1 << 22                  # vectors x nodes whose bounds are held at a time


class VantageTree:
    """Nodes over integer centroids; node i tests ``members[i]`` (its vantage point, or a leaf's
    centroids) and has ``below[i]``: (child, nearest, farthest) distances from the vantage point."""

    def __init__(self, centroids: np.ndarray):
        self.points = centroids.astype(np.int64)
        self.members: list[np.ndarray] = []
        self.below: list[list[tuple[int, float, float]]] = []
        self.reach = int(np.abs(self.points).max(initial=0))
        self._build(np.arange(len(centroids)))
        self.as_double = self.points.astype(np.float64)
        self.norms = (self.points * self.points).sum(axis=1)

    def _build(self, some: np.ndarray) -> int:
        node = len(self.members)
        self.members.append(some)
        self.below.append([])
        if len(some) <= LEAF:
            return node
        # an outlying vantage point spreads the distances
        spread = self._from(int(some[0]), some)
        vantage = int(some[spread.argmax()])
        rest = some[some != vantage]
        away = self._from(vantage, rest)
        middle = np.median(away)
        inner = away <= middle if (away > middle).any() else away < middle
        if not inner.any():                              # all equally far: one leaf
            return node
        self.members[node] = np.array([vantage])
        for part in (inner, ~inner):
            self.below[node].append((self._build(rest[part]), float(away[part].min()), float(away[part].max())))
        return node

    def _from(self, vantage: int, some: np.ndarray) -> np.ndarray:
        step = self.points[some] - self.points[vantage]
        return np.sqrt((step * step).sum(axis=1).astype(np.float64))

    def _squared(self, rows: np.ndarray, norms: np.ndarray, exact: bool, some: np.ndarray) -> np.ndarray:
        """Exact squared distances; doubles hold every term where ``exact``."""
        if exact:
            cross = rows @ self.as_double[some].T
            return (norms[:, None] + self.norms[some] - 2 * cross).astype(np.int64)
        return np.stack([((rows - self.points[c]) ** 2).sum(axis=1) for c in some], axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) of integer vectors."""
        step = max(1, _FRONTIER // len(self.members))
        parts = [self._nearest(vectors[at:at + step]) for at in range(0, len(vectors), step)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, dims = vectors.shape
        most = max(self.reach, int(np.abs(vectors).max(initial=0)))
        if dims * (2 * most) ** 2 > LARGEST:
            raise ValueError(f"components of {most} don't fit exact 64-bit distances over {dims} components")
        exact = dims * (2 * most) ** 2 < EXACT_DOUBLE
        rows = vectors.astype(np.float64) if exact else vectors
        norms = (vectors * vectors).sum(axis=1)
        best, who = np.full(n, LARGEST, np.int64), np.full(n, len(self.points), np.int64)
        bound = np.full((n, len(self.members)), np.inf)
        bound[:, 0] = 0
        active = np.arange(n)
        while len(active):
            frontier = bound[active]
            node = frontier.argmin(axis=1)
            low = frontier[np.arange(len(active)), node]
            going = low <= np.sqrt(best[active].astype(np.float64))
            active, node, low = active[going], node[going], low[going]
            for k in np.unique(node):
                here = node == k
                sel, some = active[here], self.members[k]
                bound[sel, k] = np.inf
                squared = self._squared(rows[sel], norms[sel], exact, some)
                order = np.argsort(some)                 # of equals the smaller number
                found = order[squared[:, order].argmin(axis=1)]
                far, number = squared[np.arange(len(sel)), found], some[found]
                better = (far < best[sel]) | (far == best[sel]) & (number < who[sel])
                best[sel[better]], who[sel[better]] = far[better], number[better]
                away = np.sqrt(squared[:, 0].astype(np.float64))
                for child, nearest, farthest in self.below[k]:
                    slack = 1e-9 * (1 + away + farthest)
                    gap = np.maximum(nearest - away, away - farthest) - slack
                    bound[sel, child] = np.maximum(np.maximum(gap, low[here]), 0)
        return who, best


def quantised(batch: pa.RecordBatch, dims: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and integer vectors floor(scale * x) of the rows with ``dims`` components, all finite."""
    ids, vectors = batch.column(0), batch.column(1)
    fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    ids, vectors = ids.filter(fits), vectors.filter(fits)
    x = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        q = np.floor(x[finite] * scale)
    if np.abs(q).max(initial=0) >= 1 << 52:
        raise ValueError("components beyond 2**52 have no exact integer form")
    return ids.filter(pa.array(finite)), q.astype(np.int64)


def _means(rows: list[tuple[int, int]], before: list[list[int]], dims: int) -> list[list[int]]:
    """New centroids from (cell, total) sums; cell is cluster * (dims + 1) + component, the last one counts."""
    sums = dict(rows)
    out = []
    for c, old in enumerate(before):
        n = sums.get(c * (dims + 1) + dims, 0)
        out.append([int(sums[c * (dims + 1) + i]) // int(n) for i in range(dims)] if n else old)
    return out


def cluster_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Usable are vectors of exactly ``dims`` components, none null, NaN or infinite; other rows
    give no row.  Components become floor(scale * x).  The first centroids are the vectors of
    smallest SHA-256 of ``seed:vec_id`` (null id: empty; equal ids: smaller vector first), fewer
    than ``clusters`` if there are fewer vectors.  A round moves every centroid with vectors to the
    floor of their mean; one without stays.  Ties go to the smaller number.  Repeated rows count
    each.  distance and inertia are exact; components whose distances don't fit 64 bits are an error.
    Runs one job a round, and one for the inertia.
    """
    if clusters * (dims + 1) > MAX_CELLS:
        raise ValueError(f"{clusters} centroids of {dims} components; at most {MAX_CELLS} numbers are broadcast")
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    given = vectors.select(column(vectors, vec_id).alias("vec_id"), column(vectors, vector).alias("v"))

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q = quantised(batch, dims, scale)
            flat = pa.array(q.ravel())
            lists = pa.ListArray.from_arrays(np.arange(0, q.size + 1, dims, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([ids, lists], names=["vec_id", "q"])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = given.mapInArrow(usable, f"vec_id {kind}, q array<bigint>").orderBy(
        F.sha2(name.cast("binary"), 256), "q").limit(clusters).select("q").collect()
    centroids: Sequence[Sequence[int]] = [r.q for r in first]
    shape = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], shape)

    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(np.array(centroids, np.int64)))
        cells = len(centroids) * (dims + 1)

        def totals(batches: Iterator[pa.RecordBatch], tree=tree, cells=cells) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((cells // (dims + 1), dims + 1), np.int64)
            for batch in batches:
                _, q = quantised(batch, dims, scale)
                who, _ = tree.value.nearest(q)
                order = np.argsort(who, kind="stable")
                some, at = np.unique(who[order], return_index=True)
                if len(some):
                    sums[some, :dims] += np.add.reduceat(q[order], at, axis=0)
                    sums[some, dims] += np.diff(np.append(at, len(order)))
            there = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(sums.ravel()[there])],
                                             names=["cell", "total"])

        added = given.mapInArrow(totals, "cell int, total bigint").groupBy("cell").agg(
            F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()
        # a component whose total is zero has no row
        sums = dict.fromkeys(range(cells), 0) | {r.cell: int(r.total) for r in added}
        centroids = _means(list(sums.items()), [list(c) for c in centroids], dims)
        tree.unpersist()

    tree = spark.sparkContext.broadcast(VantageTree(np.array(centroids, np.int64)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * len(centroids)
        for batch in batches:
            who, far = tree.value.nearest(quantised(batch, dims, scale)[1])
            for c in np.unique(who):
                sums[c] += sum(far[who == c].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(map(str, sums), pa.string())],
                                         names=["cluster", "total"])

    parts = given.mapInArrow(spread, "cluster int, total string").groupBy("cluster").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    inertia = [0] * len(centroids)
    for r in parts:
        inertia[r.cluster] = int(r.total)
    if sum(inertia) >= 1 << 63:
        raise ValueError("the inertia doesn't fit 64 bits")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha = pa.array(inertia, pa.int64()), pa.array(digests, pa.string())
        for batch in batches:
            ids, q = quantised(batch, dims, scale)
            who, far = tree.value.nearest(q)
            at = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(who.astype(np.int32)), pa.array(far), own.take(at),
                 pa.array(np.full(len(who), sum(inertia), np.int64)), sha.take(at)],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return given.mapInArrow(assigned, shape)
