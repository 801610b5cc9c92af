"""Exact integer k-means with a LAESA table: distances to fixed pivots rule out centroids, the rest are measured."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import col
from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST = 1 << 26  # of a component's size, so that a squared distance of up to 256 components fits 62 bits


def lattice_vectors(vectors: DataFrame, dims: int, scale: int, key: str, vector: str) -> DataFrame:
    """``(id, ints)``: vectors of exactly ``dims`` finite components as floor(scale * component)."""
    wide = F.transform(col(vector), lambda x: x.cast("double"))
    broken = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = vectors.select(col(key).alias("id"), wide.alias("vec")).where((F.size("vec") == dims) & ~broken)
    scaled = F.transform("vec", lambda x: x * F.lit(float(scale)))
    large = F.exists(scaled, lambda x: F.abs(x) >= float(MOST))
    whole = F.transform(scaled, lambda x: F.floor(x).cast("int"))
    return kept.select("id", F.when(large, F.raise_error(F.lit("a component is too large for distances in 64 bits"))).otherwise(whole).alias("ints"))


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def spread_pivots(centroids: np.ndarray, many: int) -> np.ndarray:
    """The first row, then always the row farthest from the ones taken."""
    taken = [0]
    near = squares(centroids, centroids[:1])
    while len(taken) < min(many, len(centroids)):
        taken.append(int(near.argmax()))
        near = np.minimum(near, squares(centroids, centroids[taken[-1]][None]))
    return centroids[taken]


def assign(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row and its squared distance; of equal ones the smaller number.

    ``table`` holds the rows' distances to the pivots. |d(x,p) - d(c,p)| <= d(x,c) for every pivot p, so a centroid
    whose bound is above the best exact distance so far is passed over. Bounds are in floating point and given the
    room of its errors; distances are compared as integers.
    """
    marks = np.sqrt(np.stack([squares(centroids, p[None]) for p in pivots], axis=1).astype(np.float64))
    low = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(low, np.abs(table[:, p, None] - marks[None, :, p]), out=low)
    low -= 1e-14 * (table.max(axis=1)[:, None] + marks.max(axis=1)[None])
    best = low.argmin(axis=1)
    least = squares(x, centroids[best])
    for c, centre in enumerate(centroids):
        rows = np.flatnonzero((low[:, c] <= np.sqrt(least.astype(np.float64)) * (1 + 1e-14)) & (best != c))
        if len(rows):
            exact = squares(x[rows], centre[None])
            nearer = (exact < least[rows]) | ((exact == least[rows]) & (c < best[rows]))
            best[rows[nearer]], least[rows[nearer]] = c, exact[nearer]
    return best, least


def pivot_table(whole: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """``(id, body, marks)``: components and distances to the pivots as bytes, computed and written once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, pivots.shape[1])
            marks = np.sqrt(np.stack([squares(x, p[None]) for p in pivots], axis=1).astype(np.float64))
            bodies = [row.tobytes() for row in x.astype("<i4")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary()), pa.array([m.tobytes() for m in marks.astype("<f8")], pa.binary())], ["id", "body", "marks"])

    return settle(whole.mapInArrow(measure, f"id {kind}, body binary, marks binary"))


def _opened(batch: pa.RecordBatch, dims: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").astype(np.int64).reshape(batch.num_rows, dims)
    return x, np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f8").reshape(batch.num_rows, pivots)


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors goes to the floor of their mean. A task sends one row of sums per
    centroid, Spark adds them up, and only a row per centroid comes to the driver."""
    many, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(many, np.int64), np.zeros((many, dims), np.int64)
        for batch in batches:
            x, marks = _opened(batch, dims, len(pivots))
            best, _ = assign(x, marks, centroids, pivots)
            count += np.bincount(best, minlength=many)
            np.add.at(total, best, x)
        there = np.flatnonzero(count)
        columns = [pa.array(there), pa.array(count[there]), pa.array(total[there].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    partial = table.mapInArrow(sums, "cluster long, n long, sums array<long>")
    added = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(dims)])
    out = centroids.copy()
    for row in added.collect():
        out[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(dims)]
    return out


def centroid_clusters(
    spark: SparkSession, vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, pivots: int = 8, salt: str = "2", key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that is kept.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; each component x counts as the integer
    floor(scale * x). The centroids start as the ``k`` kept vectors of smallest SHA-256 of ``salt:key`` (all, if
    fewer); a null key counts as empty there, and of rows with equal keys those with the smaller components come
    first. Every round assigns all vectors to the nearest centroid, ties to the smaller number, and moves each
    centroid that has vectors to the floor of their mean, in integers throughout; after the last round they are
    assigned once more. Equal vectors go to the same cluster, repeated rows count each, an empty table or one
    without a kept vector gives no rows. Other columns are not carried. Components of 2^26 and more after scaling are
    an error, as their distances need not fit 64 bits.

    ``pivots`` of the first centroids, far from each other, stay fixed; the distances of all vectors to them are
    written once. To the driver come k rows of the start and of each round. No row is shuffled but these sums, so it
    does not matter how many vectors a cluster or a group of copies has.
    """
    whole = settle(lattice_vectors(vectors, dims, scale, key, vector))
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = whole.select(order.alias("h"), "ints").orderBy("h", "ints").limit(k).collect()
    kind = whole.schema["id"].dataType.simpleString()
    centroids = np.array([r["ints"] for r in first], dtype=np.int64).reshape(len(first), dims)
    if not len(centroids):
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"id {kind}, {empty}").withColumnRenamed("id", key)
    fixed = spread_pivots(centroids, pivots)
    table = pivot_table(whole, fixed, kind)
    for _ in range(rounds):
        centroids = moved(table, centroids, fixed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least = assign(*_opened(batch, dims, len(fixed)), centroids, fixed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(least)], ["id", "cluster", "distance"])

    placed = settle(table.mapInArrow(place, f"id {kind}, cluster int, distance long"))
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    inertia = sum(r["s"] for r in sums)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(r["cluster"], r["s"], inertia, digests[r["cluster"]]) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most k rows
    joined = placed.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
