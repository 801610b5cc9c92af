"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, survivors again in double precision."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import col, usable
from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = "query_id long, vec_id long, score double"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows as int8, their scales, the norms of the scaled rows, and the norms of what rounding lost."""
    scale = np.maximum(np.abs(x).max(axis=1), np.finfo(np.float64).tiny) / 127
    tile = np.rint(x / scale[:, None]).astype(np.int8)
    back = tile * scale[:, None]
    return tile, scale, np.sqrt((back**2).sum(axis=1)), np.sqrt(((x - back) ** 2).sum(axis=1))


def merged(heap: list, found, k: int) -> None:
    """Keeps the k best (score, -id) in ``heap``."""
    for entry in found:
        if len(heap) < k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)


def tile_search(queries: tuple, query_ids: np.ndarray, cell: tuple, ids: np.ndarray, heaps: list[list], k: int) -> None:
    """One tile: int8 products bound every inner product from both sides; only rows whose upper bound reaches the
    k-th best lower bound are recomputed. int8 products are summed in float32, exact below 2**24, that is up to
    1040 components; wider rows are multiplied in parts of 1024."""
    x, (qx, sx, nx, rx) = queries
    y, (qy, sy, ny, ry) = cell
    dot = np.zeros((len(x), len(y)))
    for a in range(0, x.shape[1], 1024):
        dot += qx[:, a : a + 1024].astype(np.float32) @ qy[:, a : a + 1024].astype(np.float32).T
    dot *= sx[:, None] * sy
    # <x,y> = <x',y'> + <x',y-y'> + <x-x',y>; the last factor is of floating point alone
    bound = (nx[:, None] * ry + rx[:, None] * (ny + ry)) * (1 + 1e-9) + 1e-12 * nx[:, None] * ny
    low, high = dot - bound, dot + bound
    own = query_ids[:, None] == ids
    low[own] = high[own] = -np.inf
    floor = np.partition(low, len(y) - k, axis=1)[:, len(y) - k] if len(y) > k else np.full(len(x), -np.inf)
    for i, heap in enumerate(heaps):
        least = max(floor[i], heap[0][0]) if len(heap) == k else floor[i]
        near = np.flatnonzero((high[i] >= least) & ~own[i])
        # summed from the first component to the last, so that equal vectors score equal wherever they stand
        scores = np.add.accumulate(y[near] * x[i], axis=1)[:, -1] if len(near) else np.zeros(0)
        if len(near) > k:  # of equal scores the smallest ids stay
            best = np.lexsort((ids[near], -scores))[:k]
            near, scores = near[best], scores[best]
        merged(heap, zip(scores.tolist(), (-ids[near]).tolist()), k)


def strips(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one length as ``(dim, strip, ids, body)``, cut by a hash of the id."""
    sizes = settle(vectors.groupBy("dim").agg(F.ceil(F.count("*") / rows).cast("int").alias("strips")))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.to_pandas()
            out = []
            for (dim, strip, many), part in held.groupby(["dim", "strip", "strips"]):
                body = np.stack(part["vec"].to_list()).astype("<f8")
                narrow = body.astype("<f4")
                out.append((dim, strip, many, part["id"].to_numpy("<i8").tobytes(), bool((narrow == body).all()), (narrow if (narrow == body).all() else body).tobytes()))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["dim", "strip", "strips", "ids", "narrow", "body"]), preserve_index=False)

    cut = vectors.join(F.broadcast(sizes), "dim").withColumn("strip", F.pmod(F.xxhash64("id"), "strips").cast("int"))
    gathered = cut.repartition("dim", "strip").sortWithinPartitions("dim", "strip")
    return gathered.select("dim", "strip", "strips", "id", "vec").mapInArrow(block, "dim int, strip int, strips int, ids binary, narrow boolean, body binary")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", query_rows: int = 2048, rows: int = 8192
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every query row its k rows of largest inner product, itself apart.

    Rows with the same id as the query are "itself". Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor rows with a null id; a query is compared with vectors of its own length. Ties go
    to the smaller id; a row given twice is found twice. Fewer than k candidates: all of them. No queries or an empty
    table: no rows. Other columns are ignored.

    Both sides are cut into strips of bounded size by a hash of the id, and each cell of strips is one group of
    bounded memory, read in tiles. A cell sends k rows per query, which are merged by rank; Spark limits that rank
    before the shuffle. Small strips keep tasks short, large ones copy less: a candidate travels once per query strip.
    """
    wide = col(vector).cast("array<double>")
    plain = vectors.select(col(key).cast("long").alias("id"), wide.alias("vec"), is_query.alias("_asks"))
    plain = plain.where(F.col("id").isNotNull() & usable(F.col("vec"))).withColumn("dim", F.size("vec"))
    plain = settle(plain)
    asked = settle(strips(plain.where("_asks").drop("_asks"), query_rows))
    given = settle(strips(plain.drop("_asks"), rows))
    width = asked.groupBy("dim").agg(F.max("strips").alias("q_strips"))
    height = given.groupBy("dim").agg(F.max("strips").alias("c_strips"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(F.broadcast(height), "dim").withColumn("c", numbers("c_strips")).withColumn("q", F.col("strip"))
    right = given.join(F.broadcast(width), "dim").withColumn("q", numbers("q_strips")).withColumn("c", F.col("strip"))
    columns = ["dim", "q", "c", "ids", "narrow", "body"]

    def stacked(blocks: pd.DataFrame):
        ids = np.concatenate([np.frombuffer(b, "<i8") for b in blocks["ids"]])
        bodies = [np.frombuffer(b, "<f4" if narrow else "<f8") for b, narrow in zip(blocks["body"], blocks["narrow"])]
        return ids, np.concatenate(bodies).astype(np.float64).reshape(len(ids), -1)

    def cell(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or given.empty:
            return pd.DataFrame([], columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        query_ids, x = stacked(asked)
        ids, y = stacked(given)
        heaps: list[list] = [[] for _ in query_ids]
        for a in range(0, len(y), 4096):
            tile = y[a : a + 4096]
            packed = tile, quantised(tile)
            for b in range(0, len(x), 256):
                part = slice(b, b + 256)
                tile_search((x[part], quantised(x[part])), query_ids[part], packed, ids[a : a + 4096], heaps[part], k)
        out = [(q, -i, s) for q, heap in zip(query_ids.tolist(), heaps) for s, i in heap]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    cells = left.select(*columns).groupBy("dim", "q", "c").cogroup(right.select(*columns).groupBy("dim", "q", "c")).applyInPandas(cell, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = cells.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
