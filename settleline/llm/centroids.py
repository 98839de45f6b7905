"""Centroid clustering with the equal-average equal-variance nearest search.

Vectors become integers (``floor(scale * x)``).  The first centroids are the
vectors whose id hashes least; every round assigns all vectors to their nearest
centroid (squared Euclidean distance, ties to the smaller number) and moves each
non-empty centroid to its vectors' componentwise floor mean.

Nearest search (Lee and Chen, 1994): with S the sum of the components, Q that of
their squares, k their number and A = k*Q - S^2 (k^2 times the variance),

    k * d^2  >=  (Sx - Sc)^2                                   (means)
    k * d^2  >=  (Sx - Sc)^2 + (sqrt(Ax) - sqrt(Ac))^2         (deviations)

Centroids are sorted by mean.  A vector starts at its own mean and scans outward,
the nearer side first: once the means' inequality rejects a centroid, it rejects
all that are left; the deviations' inequality rejects single ones.  What is left
is settled by the exact integer distance.  All vectors of a batch take their next
centroid together.  The means' test is exact in integers; the deviations' bound is
rounded down by more than its rounding error, so no nearest centroid is lost, and
equality never rejects, since a tie may go to the smaller number.

Spark side: a round is one pass over the vectors, each task sums its vectors per
centroid, and the sums (two limbs in DECIMAL) are added up by a grouped
aggregate; the driver sees ``k x dim`` numbers a round, whatever the data.  The
vectors are read again in every round and never staged, so pass a stored table.

Defined results: vectors of another length, with a null, NaN or infinite
component (or one beyond the range of a float) are left out; so is a null vector.
A null ``vec_id`` takes part but starts no centroid.  Repeated rows are separate
vectors.  Fewer vectors than ``clusters``: as many centroids as vectors; none: an
empty result.  Components of any size stay exact; ``distance`` and the inertias
are null where they don't fit a long.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require_columns, staged

DIM = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Vectors that take a step of the search together.
ROWS = 4096
LONG_MAX = (1 << 63) - 1
LIMB = 1 << 40


def usable(embedding: Column, dim: int) -> Column:
    """Exactly ``dim`` components, all finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > F.lit(3.4028234663852886e38)))
    return F.coalesce((F.size(embedding) == dim) & ~bad, F.lit(False))


def small(dim: int) -> int:
    """Components up to this size keep all sums in 64 bits: (2 * dim * v)^2 < 2^63."""
    return int((LONG_MAX / (4 * max(1, dim) ** 2)) ** 0.5) - 1


def as_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: int64 where squares and sums stay exact, else Python integers."""
    y = np.floor(x.astype(np.float64) * scale)
    if y.size and float(np.abs(y).max()) > small(x.shape[1]):
        return np.frompyfunc(int, 1, 1)(y).reshape(y.shape)
    return y.astype(np.int64)


class Centroids:
    """Centroids sorted by mean, with the sums that the two inequalities need."""

    def __init__(self, rows: list[list[int]], dim: int):
        wide = any(abs(v) > small(dim) for r in rows for v in r)
        c = np.array(rows, dtype=object if wide else np.int64).reshape(len(rows), dim)
        s = c.sum(axis=1)
        order = np.array(sorted(range(len(rows)), key=lambda i: (s[i], i)), dtype=np.int64)
        self.number, self.at, self.sums, self.dim = order, c[order], s[order], dim
        self.spread = dim * (self.at * self.at).sum(axis=1) - self.sums * self.sums

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid, for each row of ``x``."""
        number = np.zeros(len(x), np.int64)
        distance = np.zeros(len(x), object if object in (x.dtype, self.at.dtype) else np.int64)
        for lo in range(0, len(x), ROWS):
            number[lo:lo + ROWS], distance[lo:lo + ROWS] = self._scan(x[lo:lo + ROWS])
        return number, distance

    def _scan(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k, last = len(x), self.dim, len(self.number)
        if self.at.dtype == object:
            x = x.astype(object)
        s = x.sum(axis=1)
        spread = k * (x * x).sum(axis=1) - s * s
        right = np.searchsorted(self.sums, s)  # next centroid to the right, and to the left
        left = right - 1
        best = np.full(n, -1, np.int64)  # place among the sorted centroids
        least = np.zeros(n, x.dtype)
        live = np.arange(n)
        while len(live):
            lo, hi = left[live], right[live]
            gap_lo = s[live] - self.sums[np.maximum(lo, 0)]
            gap_hi = self.sums[np.minimum(hi, last - 1)] - s[live]
            go_left = (lo >= 0) & ((hi >= last) | (gap_lo <= gap_hi))
            c = np.where(go_left, lo, hi)
            gap = np.where(go_left, gap_lo, gap_hi)
            left[live] = lo - go_left
            right[live] = hi + ~go_left
            first = best[live] < 0
            # the nearest mean left is too far: so are all others
            inside = first | (gap * gap <= k * least[live])
            live, c, gap, first = live[inside], c[inside], gap[inside], first[inside]
            a, b = spread[live], self.spread[c]
            a, b, g = a.astype(np.float64), b.astype(np.float64), gap.astype(np.float64) ** 2
            floor = g + a + b - 2 * np.sqrt(a) * np.sqrt(b) - 1e-12 * (g + a + b) - 1
            near = first | (floor <= (k * least[live]).astype(np.float64))
            at, c, first = live[near], c[near], first[near]
            diff = x[at] - self.at[c]
            d = (diff * diff).sum(axis=1)
            won = first | (d < least[at]) | ((d == least[at]) & (self.number[c] < self.number[best[at]]))
            best[at[won]], least[at[won]] = c[won], d[won]
            live = live[(left[live] >= 0) | (right[live] < last)]
        return self.number[best], least


def _vectors(batch: pa.RecordBatch, column: int, dim: int, scale: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return as_integers(flat.reshape(batch.num_rows, dim), scale)


def _first_centroids(kept: DataFrame, clusters: int, scale: int, seed: int) -> list[list[int]]:
    """The vectors whose ``<seed>:<vec_id>`` has the least hash; equal ids by their components."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id IS NOT NULL").select(rank.alias("h"), F.col("embedding")).orderBy("h", "embedding").limit(clusters).collect()
    return [as_integers(np.array([r["embedding"]], np.float64), scale)[0].tolist() for r in rows]


def _moved(kept: DataFrame, rows: list[list[int]], dim: int, scale: int) -> list[list[int]]:
    """One round: the floor mean of each centroid's vectors (empty ones stay)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Centroids(rows, dim)
        total = [[0] * dim for _ in rows]
        count = [0] * len(rows)
        for b in batches:
            x = _vectors(b, 1, dim, scale)
            number, _ = own.nearest(x)
            for c in np.unique(number):
                mine = x[number == c]
                count[c] += len(mine)
                total[c] = [t + int(v) for t, v in zip(total[c], mine.sum(axis=0))]
        out = [(c, i, count[c], *divmod(v, LIMB)) for c in range(len(rows)) if count[c] for i, v in enumerate(total[c])]
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38), pa.decimal128(38)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds)], names=["c", "i", "n", "hi", "lo"])

    added = kept.mapInArrow(sums, "c int, i int, n long, hi decimal(38,0), lo decimal(38,0)").groupBy("c", "i").agg(
        F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()
    out = [list(r) for r in rows]
    for r in added:  # clusters x dim rows
        out[r["c"]][r["i"]] = (int(r["hi"]) * LIMB + int(r["lo"])) // r["n"]
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` of every usable vector, and the final centroids."""
    require_columns(vectors, ["vec_id", "embedding"])
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        usable(F.col("embedding"), dim))
    rows = _first_centroids(kept, clusters, scale, seed)
    schema = "vec_id long, cluster int, distance long"
    if not rows and kept.isEmpty():
        return spark.createDataFrame([], schema), []
    if not rows:
        raise ValueError("no vector has an id: nothing to start a centroid from")
    for _ in range(rounds):
        rows = _moved(kept, rows, dim, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Centroids(rows, dim)
        for b in batches:
            number, distance = own.nearest(_vectors(b, 1, dim, scale))
            fits = [int(d) if d <= LONG_MAX else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number, pa.int32()), pa.array(fits, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return kept.mapInArrow(assign, schema), rows


def clusters_with_inertia(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM,
                          scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    The inertias are the distances summed over the cluster and over all; the hash
    is that of the final centroid's components in decimal, joined by commas.
    """
    spark = vectors.sparkSession
    assigned, rows = cluster(vectors, clusters, rounds, dim, scale, seed)
    assigned = staged(assigned, "clusters")
    by = {r["cluster"]: (None if r["gaps"] else int(r["d"])) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.max(F.col("distance").isNull()).alias("gaps")).collect()}
    total = None if None in by.values() else sum(by.values())

    def fits(v: int | None) -> int | None:
        return v if v is not None and v <= LONG_MAX else None

    named = spark.createDataFrame(
        [(c, fits(v), fits(total), hashlib.sha256(",".join(map(str, rows[c])).encode()).hexdigest()) for c, v in by.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(  # at most ``clusters`` rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
