"""Centroid clustering with block-norm screening: exact integer rounds in which few vectors meet few centroids.

Vectors become integers (floor(scale * x)).  Each is stored once, cut into SEGMENTS blocks, in a compressed form beside its
components: the sum of every block and the norm of what the block's mean leaves over.  For a block of w components with sums
p, q and residual norms r, t of vector and centroid, the block's squared distance is (p - q)**2 / w plus that of the
residuals, which by Cauchy-Schwarz is at least (r - t)**2.  The sum over the blocks is a lower bound that costs two products
of small matrices for a batch.  The centroid of the smallest bound gets its exact distance first; only centroids whose bound
does not exceed it get theirs.  Distances are exact integers, so bounds decide nothing but what need not be computed: they
are lowered by more than any rounding (SLACK).

A round is one pass over the stored vectors: a task returns one row of sums for each centroid, whatever it read, so neither a
frequent vector nor a large cluster is ever gathered; sums and counts are added by Spark and one row a centroid goes to the
driver.

Defined results: vectors that are null, of another length or hold null or non-finite components take no part; repeated ids
and vectors are separate rows; a null id ranks last as a first centroid; equal ranks are ordered by components; without
vectors there are no rows; fewer vectors than centroids give so many centroids.  A component beyond LIMIT raises an error, as
its squared distances would not fit 64 bits.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import buffers

DIMENSIONS, SEGMENTS, SCALE = 64, 8, 64
CENTROIDS, ROUNDS, SEED = 16, 3, 1
#: Components are at most this in absolute value: a difference has 28 bits, its square 56, the sum of 64 of them 62.
LIMIT = 1 << 27
#: Bounds are lowered by this share of the squared norms involved; their rounding is below a thousandth of it.
SLACK = 1e-11
BATCH = 1 << 13


def compressed(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(block sums divided by the root of the block's width, residual norms) of the rows of x."""
    blocks = x.reshape(len(x), segments, -1).astype(float)
    width = blocks.shape[2]
    sums = blocks.sum(axis=2)
    rest = blocks - sums[:, :, None] / width
    return sums / np.sqrt(width), np.sqrt((rest * rest).sum(axis=2))


def lower_bounds(sums: np.ndarray, norms: np.ndarray, centres: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A lower bound of the squared distance of every row to every centroid, from the compressed forms alone."""
    own, far = np.hstack([sums, norms]), np.hstack(centres)
    size, far_size = (own * own).sum(axis=1)[:, None], (far * far).sum(axis=1)[None, :]
    return size + far_size - 2 * (own @ far.T) - SLACK * (size + far_size) - 1e-6


def nearest(x: np.ndarray, sums: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, exact squared distance, exact distances computed) of integer rows x; ties: the smaller number."""
    bound = lower_bounds(sums, norms, compressed(centroids, sums.shape[1]))

    def exact(row: np.ndarray, centre: np.ndarray) -> np.ndarray:
        gap = x[row] - centroids[centre]
        return np.einsum("ij,ij->i", gap, gap)

    rows = np.arange(len(x))
    best = bound.argmin(axis=1)
    distance = exact(rows, best)
    bound[rows, best] = np.inf
    row, centre = np.nonzero(bound <= distance[:, None].astype(float) * (1 + 1e-12))
    found = exact(row, centre)
    order = np.lexsort((centre, found, row))
    row, centre, found = row[order], centre[order], found[order]
    row, at = np.unique(row, return_index=True)  # the best screened centroid of each row that has any
    centre, found = centre[at], found[at]
    win = (found < distance[row]) | ((found == distance[row]) & (centre < best[row]))
    best[row[win]], distance[row[win]] = centre[win], found[win]
    return best, distance, len(x) + len(order)


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, segments: int = SEGMENTS) -> DataFrame:
    """vec_id, v (integer components), sums, norms of the vectors that take part, packed as little-endian bytes."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where((F.size("e") == dimensions) & ~F.exists("e", odd))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions))
            if np.abs(x).max() > LIMIT:
                raise OverflowError(f"a component is beyond {LIMIT}: squared distances would not fit 64 bits")
            sums, norms = compressed(x, segments)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(_packed(m) for m in (x.astype("<i4"), sums, norms))], ["vec_id", "v", "sums", "norms"])

    return rows.mapInArrow(pack, "vec_id long, v binary, sums binary, norms binary")


def _packed(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return buffers(column)[0].view(kind).reshape(-1, width)


def _read(batches: Iterator[pa.RecordBatch], dimensions: int, segments: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            x = _unpacked(part.column(1), "<i4", dimensions).astype(np.int64)
            yield part.column(0), x, _unpacked(part.column(2), "<f8", segments), _unpacked(part.column(3), "<f8", segments)


def first_centroids(rows: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The k vectors of smallest SHA-256 of `seed:vec_id`, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.select(rank.alias("rank"), "v").orderBy(F.col("rank").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in found], np.int64)


def _moved(rows: DataFrame, centroids: np.ndarray, segments: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of what is nearest to each, or itself where nothing is."""
    k, dimensions = centroids.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, x, s, r in _read(batches, dimensions, segments):
            best = nearest(x, s, r, centroids)[0]
            n += np.bincount(best, minlength=k)
            for c in np.unique(best):
                sums[c] += x[best == c].sum(axis=0)
        some = np.flatnonzero(n)
        flat = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * dimensions, sums[some].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), flat], ["cluster", "n", "sums"])

    parts = rows.mapInArrow(totals, "cluster long, n long, sums array<long>").groupBy("cluster")
    out = centroids.copy()
    for r in parts.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dimensions)]).alias("sums")).collect():
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE, segments: int = SEGMENTS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every vector that takes part; the final centroids).  segments divides dimensions."""
    rows = written(kept(vectors, dimensions, scale, segments), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = _moved(rows, centroids, segments)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, s, r in _read(batches, dimensions, segments):
            best, distance, _ = nearest(x, s, r, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids


def digests(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    found, centroids = clusters(vectors, **options)
    found = written(found, "clusters")
    spark = found.sparkSession
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a centroid
    facts = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
