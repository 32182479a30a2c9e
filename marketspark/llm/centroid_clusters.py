"""Centroid clustering with a progressive search over Walsh-Hadamard coefficients, in exact integers.

Vectors become integers and then their Walsh-Hadamard spectrum, coarse coefficients first. The transform keeps
squared distances but for the factor ``size``, so a sum over the first coefficients never exceeds the whole. For
each vector the centroid that leads after the first block is finished; every centroid whose sum passes that
distance is strictly worse and goes, block by block, and what is left is summed to the end.

Spectra are stored once. A round is one pass over them: each task returns one row for each centroid with the
count and the summed spectrum, and their total is transformed back, which gives the exact sum of the vectors.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import stored

BLOCK = 8
PAIRS_AT_ONCE = 1 << 17
# A coefficient stays below this, so that it fits 32 bits and ``size`` times a squared distance 64.
LARGEST_COEFFICIENT = 1 << 30
MOST_COMPONENTS = 1 << 10
MOST_CENTROIDS = 1 << 12
RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, "
    "centroid array<long>")


def transformed(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row in natural order: twice gives the row times its length."""
    size, width = x.shape[1], 1
    while width < size:
        pairs = x.reshape(len(x), -1, 2, width)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
        width *= 2
    return x


@functools.lru_cache(maxsize=8)
def coarse_first(size: int) -> np.ndarray:
    """Places of the coefficients by the number of sign changes of their Walsh function."""
    return np.argsort((np.diff(transformed(np.eye(size, dtype=np.int64)), axis=1) != 0).sum(axis=1), kind="stable")


def spectrum(x: np.ndarray) -> np.ndarray:
    return transformed(x)[:, coarse_first(x.shape[1])]


def components_of(total: np.ndarray) -> np.ndarray:
    """Rows from their spectra, in exact integers of any size."""
    size = total.shape[1]
    natural = np.empty(total.shape, object)
    natural[:, coarse_first(size)] = total
    return transformed(natural) // size


def nearest(spectra: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number of equals, and the squared distance."""
    n, size = spectra.shape
    sums = np.zeros((n, len(centroids)), np.int64)
    for at in range(min(BLOCK, size)):
        sums += (spectra[:, at, None] - centroids[None, :, at]) ** 2
    lead = sums.argmin(axis=1)
    bound = ((spectra - centroids[lead]) ** 2).sum(axis=1)
    rows, numbers = np.nonzero(sums <= bound[:, None])
    partial = sums[rows, numbers]
    for at in range(BLOCK, size, BLOCK):
        partial = partial + ((spectra[rows, at:at + BLOCK] - centroids[numbers, at:at + BLOCK]) ** 2).sum(axis=1)
        left = partial <= bound[rows]
        rows, numbers, partial = rows[left], numbers[left], partial[left]
    sums[:] = np.iinfo(np.int64).max
    sums[rows, numbers] = partial
    best = sums.argmin(axis=1)
    return best, sums[np.arange(n), best] // size


def slices(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches and their spectra, so few rows at once that all pairs with centroids stay bounded."""
    step = max(1, PAIRS_AT_ONCE // len(centroids))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            raw = b"".join(part.column("spectrum").to_pylist())
            yield part, np.frombuffer(raw, "<i4").reshape(part.num_rows, -1).astype(np.int64)


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, size: int, scale: int) -> DataFrame:
    """(vec_id, spectrum) of the rows whose vector can be kept; the spectrum is packed in 32-bit integers."""

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LARGEST_COEFFICIENT // size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, size)
            packed = spectrum(values).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([row.tobytes() for row in packed], pa.binary())], ["vec_id", "spectrum"])

    picked = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    kept = picked.filter((F.size("vector") == size) & F.forall("vector", usable))
    whole = kept.select("vec_id", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)).alias("x"))
    return whole.mapInArrow(pack, "vec_id long, spectrum binary")


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid as the floor of the mean of its vectors, or as it was if it has none."""
    spectra = spectrum(np.array(centroids, np.int64))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(len(spectra), np.int64), np.zeros(spectra.shape, np.int64)
        for _, own in slices(batches, spectra):
            best, _ = nearest(own, spectra)
            counts += np.bincount(best, minlength=len(spectra))
            np.add.at(totals, best, own)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int64()), pa.array(counts[filled]), pa.array(list(totals[filled]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"])

    sums = rows.select("spectrum").mapInArrow(add_up, "cluster long, n long, total array<long>")
    wide = sums.select("cluster", "n", F.posexplode("total").alias("place", "value"))
    found = wide.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    totals, counts = np.zeros(spectra.shape, object), {}
    for row in found:  # centroids times components, whatever the number of vectors
        totals[row.cluster, row.place] = int(row.value)
        counts[row.cluster] = row.n
    exact = components_of(totals)
    return [[int(x) // counts[c] for x in exact[c]] if c in counts else own for c, own in enumerate(centroids)]


def cluster_vectors(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: str = "1",
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    A vector is kept if it has ``size`` components (a power of two), none of them null, NaN or infinite, or so
    large that its integer form passes 2^30 / size; components become floor(scale * x). First centroids are the
    vectors of least SHA-256 of ``seed:vec_id``, fewer if fewer are kept; rows without id come last there, repeated
    ids are ordered by their vectors. Ties between centroids go to the smaller number, and a centroid without
    vectors stays. Repeated rows count each. Extra columns are left out; an empty table gives an empty result. An
    inertia beyond a long is null. The driver holds centroids alone, at most ``MOST_CENTROIDS`` of them.
    """
    if size < 1 or size & (size - 1) or size > MOST_COMPONENTS:
        raise ValueError(f"size must be a power of two up to {MOST_COMPONENTS}")
    if not 1 <= clusters <= MOST_CENTROIDS:
        raise ValueError(f"clusters must be from 1 to {MOST_CENTROIDS}")
    rows = stored(integer_vectors(vectors, id_column, vector_column, size, scale), "spectra")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "spectrum").limit(clusters).collect()
    if not first:
        return vectors.sparkSession.createDataFrame([], RESULT)
    raw = np.array([np.frombuffer(row.spectrum, "<i4") for row in first], np.int64)
    centroids = [[int(x) for x in row] for row in components_of(raw.astype(object))]
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    last = spectrum(np.array(centroids, np.int64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in slices(batches, last):
            best, distance = nearest(own, last)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = stored(rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    inertia = {row.cluster: int(row.sum) for row in sums}  # a number for each centroid
    whole = as_long(sum(inertia.values()))
    named = [
        (c, as_long(inertia.get(c, 0)), whole, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), x)
        for c, x in enumerate(centroids)]
    totals = vectors.sparkSession.createDataFrame(
        named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return assigned.join(F.broadcast(totals), "cluster").select(*(name.split()[0] for name in RESULT.split(", ")))


def as_long(x: int) -> int | None:
    return x if x < 1 << 63 else None
