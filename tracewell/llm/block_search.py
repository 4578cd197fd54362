"""Exact nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are dealt into blocks; each pair of blocks is one tile, multiplied in
8-bit integers. The exact norms of the quantisation errors bound how far a tile's product can
be from the true one, so a pair is left only if its upper bound is below the k-th best lower
bound. What survives is recomputed in double precision and goes into the queries' heaps; the
heaps of all tiles are merged by a ranked window, which cuts them to k before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most numbers in a block of vectors; small tables get up to SPREAD blocks of LEAST_NUMBERS.
BLOCK_NUMBERS, LEAST_NUMBERS, SPREAD = 1 << 24, 1 << 19, 64
#: Rows of a tile that are multiplied at once.
TILE_ROWS = 2048
#: Dimensions multiplied at once: sums of so many int8 products are exact in 32-bit floats.
CHUNK = 1024


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes in [-127, 127] as float32, scale, norm of what they stand for, norm of the error) of the rows of x (double)."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None])
    back = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two int8 matrices held as float32."""
    if a.shape[1] <= CHUNK:
        return a @ b.T
    return sum((a[:, i : i + CHUNK] @ b[:, i : i + CHUNK].T).astype(np.float64) for i in range(0, a.shape[1], CHUNK))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, summed in the order of the dimensions."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def search_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec id, score) of the k best candidates of each query of a tile."""
    heap_at = np.zeros(0, np.int64)  # query's row, vec id and score of what is in the heaps
    heap_ids, heap_scores = np.zeros(0, np.int64), np.zeros(0)
    q_codes, q_scale, _, q_error = quantise(q)
    q_norm = np.linalg.norm(q, axis=1)
    floor = np.full(len(q), -np.inf)  # the k-th best known so far
    for at in range(0, len(c), TILE_ROWS):
        part, ids = c[at : at + TILE_ROWS], c_ids[at : at + TILE_ROWS]
        codes, scale, back, error = quantise(part)
        for top in range(0, len(q), TILE_ROWS):
            rows = slice(top, top + TILE_ROWS)
            near = product(q_codes[rows], codes) * (q_scale[rows, None] * scale)
            slack = (q_error[rows, None] * back + q_norm[rows, None] * error) * (1 + 1e-9) + 1e-12 * q_norm[rows, None]
            low = near - slack
            low[q_ids[rows, None] == ids] = -np.inf
            if len(ids) > k:
                floor[rows] = np.maximum(floor[rows], np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k])
            i, j = np.nonzero((near + slack >= floor[rows, None]) & (q_ids[rows, None] != ids))
            i = i + top
            heap_at, heap_ids = np.concatenate([heap_at, i]), np.concatenate([heap_ids, ids[j]])
            heap_scores = np.concatenate([heap_scores, exact(q[i], part[j])])
        order = np.lexsort((heap_ids, -heap_scores, heap_at))
        heap_at, heap_ids, heap_scores = heap_at[order], heap_ids[order], heap_scores[order]
        place = np.arange(len(heap_at)) - np.searchsorted(heap_at, heap_at)
        kept = place < k
        last = place == k - 1
        floor[heap_at[last]] = np.maximum(floor[heap_at[last]], heap_scores[last])
        heap_at, heap_ids, heap_scores = heap_at[kept], heap_ids[kept], heap_scores[kept]
    return q_ids[heap_at], heap_ids, heap_scores


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("_id").to_numpy()
    flat = table.column("_vector").combine_chunks()
    flat = flat.values if isinstance(flat, pa.ListArray) and flat.offset == 0 else pa.concat_arrays([flat]).flatten()
    return ids, flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each query row.

    Ties go to the smaller vec_id. Rows with a null id or an unusable vector take no part; a
    query meets vectors of its own dimension only, and none with its own vec_id. Of rows with equal
    vectors only the k + 1 of smallest ids can be in a result; the others go before the join.
    Rows that repeat vec_id and vector count once. Other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("_id"), F.col(vector).alias("_vector"), F.coalesce(is_query, F.lit(False)).alias("_query"))
    rows = rows.where(F.col("_id").isNotNull() & usable(F.col("_vector"))).withColumn("_dim", F.size("_vector"))
    n, n_queries, dim = rows.agg(F.count(F.lit(1)), F.count_if("_query"), F.max("_dim")).first()
    # Each block of candidates sends k rows a query, so there are as few as memory and parallel work allow.
    block = max(TILE_ROWS, BLOCK_NUMBERS // max(dim or 1, 1))
    c_blocks = max(1, -(-n // block), min(SPREAD, n * (dim or 1) // LEAST_NUMBERS))
    q_blocks = max(1, -(-n_queries // block))
    same = Window.partitionBy("_dim", "_vector").orderBy("_id")
    some = rows.select("_dim", "_vector", "_id").distinct().withColumn("_place", F.row_number().over(same)).where(F.col("_place") <= k + 1)
    dealt = lambda count: F.pmod(F.xxhash64("_id", "_vector"), F.lit(count))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    candidates = some.select("_id", "_vector", "_dim", dealt(c_blocks).alias("_c"), each(q_blocks).alias("_q"))
    queries = rows.where("_query").select("_id", "_vector", "_dim").distinct().select("_id", "_vector", "_dim", dealt(q_blocks).alias("_q"), each(c_blocks).alias("_c"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            found = search_tile(*_matrix(left), *_matrix(right), k)
        return pa.table([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    keys = "_dim", "_q", "_c"
    tiles = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
