"""Hard negatives of labelled vectors by a secondary-sort shuffle.

Every pair's score goes into the key (anchor, score downwards, id). The shuffle deals keys out by
anchor and sorts them within each partition, so that a streaming iterator meets an anchor's
rows from the nearest to the farthest: a row of the anchor's label opens a window below its
score, a row of another label goes to all windows that it lies in, and nothing of an anchor is held
but its open windows.

Pairs are scored in blocks of anchors and rows, and a block sends only what can still be in the
result: first, of an anchor's positives, its nearest few, from which follow the windows; then, of
all other rows, the first few in each of these windows. So an anchor sends some rows a block to
the shuffle, not one for each row of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import stage

#: Most numbers in a block of vectors; small tables get up to SPREAD blocks of LEAST_NUMBERS.
BLOCK_NUMBERS, LEAST_NUMBERS, SPREAD = 1 << 24, 1 << 19, 64
#: Rows of a tile that are multiplied at once.
TILE_ROWS = 1024

_PAIRS = "anchor_id long, anchor_key long, score long, vec_id long, row_key long, same boolean"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no component null or not finite."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def codes(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of the components as doubles, which are whole numbers; one row a vector."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact 64-bit inner products of the rows of two matrices of whole numbers; fails if one may not fit."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:  # every partial sum is exact
        return (a @ b.T).astype(np.int64)
    if most < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    return np.array(exact, np.int64).reshape(len(a), len(b))  # OverflowError beyond 64 bits


def firsts(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group `at`: higher scores first, then smaller ids."""
    order = np.lexsort((keys, ids, -scores, at))
    group = at[order]
    return order[np.arange(len(order)) - np.searchsorted(group, group) < k]


def leading(scores: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row's scores that are ok, and of all that equal the least of these."""
    least = np.iinfo(np.int64).min
    held = np.where(ok, scores, least)
    floor = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k] if held.shape[1] > k else np.full(len(held), least)
    return np.nonzero((held >= floor[:, None]) & ok)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(table.column(c).to_numpy() for c in ("_id", "_key", "_label")) + (table.column("_vector").combine_chunks(),)


def _pairs(a_id: np.ndarray, a_key: np.ndarray, score: np.ndarray, c_id: np.ndarray, c_key: np.ndarray, same: bool) -> pa.Table:
    return pa.table([a_id, a_key, score, c_id, c_key, np.full(len(score), same)], names=["anchor_id", "anchor_key", "score", "vec_id", "row_key", "same"])


def _empty() -> pa.Table:
    none = np.zeros(0, np.int64)
    return _pairs(none, none, none, none, none, True)


def near_positives(anchors: pa.Table, rows: pa.Table, k: int, scale: int) -> pa.Table:
    """The first k rows of each anchor's label in a block, but for the anchor itself."""
    if not anchors.num_rows or not rows.num_rows:
        return _empty()
    a_id, a_key, a_label, a_vector = _columns(anchors)
    c_id, c_key, c_label, c_vector = _columns(rows)
    a, c = codes(a_vector, scale), codes(c_vector, scale)
    found: list[tuple[np.ndarray, ...]] = []
    for label in np.unique(a_label):
        left, right = np.flatnonzero(a_label == label), np.flatnonzero(c_label == label)
        for at in range(0, len(left), TILE_ROWS):
            some = left[at : at + TILE_ROWS]
            best = [np.zeros(0, np.int64)] * 3  # anchor's place, row's place, score
            for to in range(0, len(right), TILE_ROWS):
                part = right[to : to + TILE_ROWS]
                scores = products(a[some], c[part])
                own = (a_id[some][:, None] == c_id[part]) & (a_key[some][:, None] == c_key[part])
                i, j = leading(scores, ~own, k)
                best = [np.concatenate(x) for x in zip(best, (some[i], part[j], scores[i, j]), strict=True)]
                first = firsts(best[0], best[2], c_id[best[1]], c_key[best[1]], k)
                best = [x[first] for x in best]
            found.append(tuple(best))
    if not found:
        return _empty()
    i, j, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    return _pairs(a_id[i], a_key[i], scores, c_id[j], c_key[j], True)


def window_negatives(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int, scale: int) -> pa.Table:
    """The first k rows of other labels in each window of an anchor in a block; a row in several windows comes once."""
    if not anchors.num_rows or not rows.num_rows:
        return _empty()
    a_id, a_key, a_label, a_vector = _columns(anchors)
    c_id, c_key, c_label, c_vector = _columns(rows)
    a, c = codes(a_vector, scale), codes(c_vector, scale)
    opened = anchors.column("_windows").combine_chunks()
    tops = opened.flatten().to_numpy(zero_copy_only=False)
    edge = opened.offsets.to_numpy() - opened.offsets[0].as_py()
    slots = int(np.diff(edge).max(initial=0))
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(a), TILE_ROWS):
        some = np.arange(at, min(at + TILE_ROWS, len(a)))
        bests = [[np.zeros(0, np.int64)] * 3 for _ in range(slots)]
        for to in range(0, len(c), TILE_ROWS):
            part = np.arange(to, min(to + TILE_ROWS, len(c)))
            scores = products(a[some], c[part])
            other = a_label[some][:, None] != c_label[part]
            for slot, best in enumerate(bests):
                has = np.flatnonzero(edge[some] + slot < edge[some + 1])
                # 100 * score lies between low * top and high * top, which themselves may not fit 64 bits.
                hundreds, rest = np.divmod(tops[edge[some[has]] + slot], 100)
                least, most = hundreds * low - (-rest * low) // 100, hundreds * high + rest * high // 100
                i, j = leading(scores[has], (scores[has] >= least[:, None]) & (scores[has] <= most[:, None]) & other[has], k)
                best = [np.concatenate(x) for x in zip(best, (some[has[i]], part[j], scores[has[i], j]), strict=True)]
                first = firsts(best[0], best[2], c_id[best[1]], c_key[best[1]], k)
                bests[slot] = [x[first] for x in best]
        found += map(tuple, bests)
    if not found:
        return _empty()
    i, j, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    once = np.unique(i * np.int64(len(c)) + j, return_index=True)[1]
    i, j, scores = i[once], j[once], scores[once]
    return _pairs(a_id[i], a_key[i], scores, c_id[j], c_key[j], False)


def mined(batches: Iterator[pa.RecordBatch], positives: int, negatives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Pairs in the order of (anchor, score downwards, positives first, id) in; (anchor, positive, rank, negative) with both scores out.

    Holds the windows of one anchor: (positive's score and id, negatives so far).
    """
    anchor, opened, seen = None, [], 0
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("anchor_id", "anchor_key", "score", "vec_id", "same")]
        for a_id, a_key, score, vec_id, same in zip(*columns, strict=True):
            if (a_id, a_key) != anchor:
                anchor, opened, seen = (a_id, a_key), [], 0
            if same:
                if seen < positives:
                    seen += 1
                    opened.append([score, vec_id, 0])
                continue
            for window in opened:
                top = window[0]
                if low * top <= 100 * score <= high * top:
                    window[2] += 1
                    out.append((a_id, window[1], window[2], vec_id, top, score))
            # Full windows are closed, and those whose end has passed.
            opened = [w for w in opened if w[2] < negatives and low * w[0] <= 100 * score]
        arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [()] * 6, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), a row for each negative of an anchor and positive.

    A score is the inner product of floor(scale * x), exact in 64 bits (an error beyond); higher ones
    come first, ties by smaller vec_id. Positives are an anchor's first other rows of its label; of each, the negatives are
    the first rows of other labels whose score is at least `low` and at most `high` percent of the positive's. A positive below 0
    has none. Rows with a null id, label or vector, or a component that is null or not finite, take no part; an anchor
    meets rows of its own dimension only. Rows that repeat id, label and vector count once; other
    rows of one id are rows of their own. Of rows with equal label and vector only those of the smallest ids can be in a
    result; the others go before any pair is made. Other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("_id"), F.col(vector).alias("_vector"), F.col(label).cast("bigint").alias("_label"), F.coalesce(is_anchor, F.lit(False)).alias("_anchor"))
    rows = rows.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & usable(F.col("_vector")))
    rows = rows.withColumn("_dim", F.size("_vector")).withColumn("_key", F.xxhash64("_label", "_vector"))
    same = Window.partitionBy("_dim", "_label", "_vector").orderBy("_id")
    kept = rows.select("_dim", "_label", "_vector", "_id", "_key").distinct().withColumn("_place", F.row_number().over(same)).where(F.col("_place") <= max(positives + 1, negatives)).drop("_place")
    kept = stage(kept, "candidates")
    anchors = stage(rows.where("_anchor").select("_dim", "_label", "_vector", "_id", "_key").distinct(), "anchors")
    (n, dim), n_anchors = kept.agg(F.count(F.lit(1)), F.max("_dim")).first(), anchors.count()
    block = max(TILE_ROWS, BLOCK_NUMBERS // max(dim or 1, 1))
    c_blocks = max(1, -(-n // block), min(SPREAD, n * (dim or 1) // LEAST_NUMBERS))
    a_blocks = max(1, -(-n_anchors // block))
    dealt = lambda count: F.pmod(F.xxhash64("_id", "_key"), F.lit(count))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    candidates = kept.select("_id", "_key", "_label", "_vector", "_dim", dealt(c_blocks).alias("_c"), each(a_blocks).alias("_a")).groupBy("_dim", "_a", "_c")

    def tiles(left: DataFrame, make) -> DataFrame:
        own = [c for c in ("_id", "_key", "_label", "_vector", "_dim", "_windows") if c in left.columns]
        return left.select(*own, dealt(a_blocks).alias("_a"), each(c_blocks).alias("_c")).groupBy("_dim", "_a", "_c").cogroup(candidates).applyInArrow(make, _PAIRS)

    near = tiles(anchors, lambda a, c: near_positives(a, c, positives, scale))
    best = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "vec_id", "row_key")
    near = stage(near.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= positives).drop("_place"), "positives")
    # At most `positives` windows an anchor; equal scores have one window.
    opened = near.where("score >= 0").groupBy(F.col("anchor_id").alias("_id"), F.col("anchor_key").alias("_key")).agg(F.array_sort(F.collect_set("score")).alias("_windows"))
    far = tiles(anchors.join(opened, ["_id", "_key"]), lambda a, c: window_negatives(a, c, negatives, low, high, scale))
    keys = near.unionByName(far).withColumn("_down", -F.col("score"))
    # The secondary sort: keys are dealt out by anchor, and sorted by the whole key within each partition. Of equal
    # scores positives come first, since a window of 0 takes scores of 0.
    order = ["anchor_id", "anchor_key", "_down", F.desc("same"), "vec_id", "row_key"]
    dealt_out = keys.repartition("anchor_id", "anchor_key").sortWithinPartitions(*order)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return dealt_out.drop("_down").mapInArrow(lambda batches: mined(batches, positives, negatives, low, high), schema)
