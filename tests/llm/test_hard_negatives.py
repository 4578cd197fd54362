"""Hard negatives against brute force, over tables and awkward vectors."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewell.llm import hard_negatives, oracles, queries
from tracewell.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    good = {(i, tuple(v), y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    coded = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in sorted(good)]
    out = []
    for a in coded:
        if not is_anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], b[1], strict=True)), b[0], b[2]) for b in coded if b is not a and len(b[1]) == len(a[1]))
        for down, p, _ in [s for s in scored if s[2] == a[2]][:positives]:
            fits = [(n, -s) for s, n, y in scored if y != a[2] and low * -down <= 100 * -s <= high * -down]
            out += [(a[0], p, k, n, -down, s) for k, (n, s) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def of(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(spark, sf):
    got = of(queries.op11_hard_negatives(spark, sf))
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table(spark, sf, "embeddings").collect()]
    assert got and got == brute(rows, lambda i: i % 50 == 0)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(oracles.OP11).fetchall())


def awkward():
    chance = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in chance.normal(size=3)], int(chance.integers(3))) for i in range(150)]
    rows += [(i, [1.0, 2.0, 3.0], i % 2) for i in range(200, 320)]  # large groups of copies, ties
    rows += [(i, [0.0, 0.0, 0.0], i % 2) for i in range(320, 340)]  # scores of 0: negatives of smaller ids than their positive
    rows += [(i, [float(i % 4), 1.0], i % 2) for i in range(340, 380)]  # another dimension
    rows += [(400, None, 1), (410, [], 1), (420, [1.0, None, 1.0], 1), (430, [float("nan"), 1.0, 1.0], 1), (440, [float("inf"), 1.0, 1.0], 1), (450, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    return rows + [(460, [3.0, 3.0, 3.0], 2)] * 3 + [(411, [], 2), (470, [1e6, 1e6, -1e6], 0), (480, [2e5, 1e6, 1.0], 1), (490, [9e5, 9e5, 1.0], 0)]


@pytest.mark.parametrize(("tile", "numbers"), [(7, 50), (1024, 1 << 19)])
def test_awkward(spark, monkeypatch, tile, numbers):
    """Several blocks and tiles, or one; ids, labels and vectors that take no part; copies, ties and repeated rows."""
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "LEAST_NUMBERS", numbers)
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("score", "rank", "_id", "anchor_id"):
        df = df.withColumn(name, F.lit("own"))
    got = of(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert {(r[0], r[4]) for r in got} >= {(330, 0)}
    assert of(hard_negatives.hard_negatives(df.where("false"), F.col("vec_id") % 10 == 0)) == []
    assert of(hard_negatives.hard_negatives(df, F.lit(None).cast("boolean"))) == []


def test_products():
    """Exact beyond doubles and beyond 64-bit partial sums; a score that doesn't fit is an error."""
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [5.0, 7.0]])
    assert hard_negatives.products(a, b).tolist() == [[2**60 + 3, 5 * 2**40 + 21]]
    a, b = np.array([[2.0**40, 2.0**40]]), np.array([[2.0**30, -(2.0**30)]])
    assert hard_negatives.products(a, b).tolist() == [[0]]
    with pytest.raises(OverflowError):
        hard_negatives.products(a, np.abs(b))


def test_state_over_batches():
    """Windows stay open from one batch to the next, and are dropped with their anchor."""
    rows = [(1, 0, 100, 9, True), (1, 0, 95, 5, False), (1, 0, 90, 6, False), (1, 0, 80, 8, True), (1, 0, 60, 7, False), (1, 0, 45, 4, False), (2, 0, 60, 3, False)]
    names = ["anchor_id", "anchor_key", "score", "vec_id", "same"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True))]) for r in rows]
    got = [tuple(r.values()) for b in hard_negatives.mined(iter(batches), 5, 3, 50, 95) for r in b.to_pylist()]
    assert got == [(1, 9, 1, 5, 100, 95), (1, 9, 2, 6, 100, 90), (1, 9, 3, 7, 100, 60), (1, 8, 1, 7, 80, 60), (1, 8, 2, 4, 80, 45)]
