"""Decontamination against brute force: tables, planted and awkward texts, items of all lengths."""

import random
import re
import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tracewell.llm import contamination, oracles, queries  # noqa: E402
from tracewell.llm.common import table  # noqa: E402
from tracewell.llm.word_hash import ALNUM, word_hashes  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def wanted(docs, items):
    """[(doc_id, n_words, places hit, items)] by comparing words."""
    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        m = min(len(w), 10)
        for s in range(len(w) - m + 1) if w else ():
            windows[tuple(w[s : s + m])].add("" if i is None else str(i))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if ids := windows.get(tuple(w[s : s + m])):
                    hit |= set(range(s, s + m))
                    found |= ids
        out.append((doc, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def got(df):
    out = []
    for r in df.collect():
        hit = {p for w in r.windows for p in range(w.start, w.start + w.size)}
        assert len(hit) == r.n_hit and list(r.windows) == sorted(r.windows)
        out.append((r.doc_id, r.n_words, sorted(hit), list(r["items"])))
    return sorted(out, key=str)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    rows = queries.op13_decontaminate(spark, sf).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == [
        (d, n, len(hit), len(ids), brute.sha(",".join(ids)), bool(hit)) for d, n, hit, ids in sorted(wanted(docs, items))
    ]
    assert 0 < sum(r.contaminated for r in rows) < len(rows)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    assert sorted(map(tuple, rows)) == sorted(con.execute(oracles.OP13).fetchall())


ITEMS = [(1, "The quick, brown FOX jumps over the lazy dog and runs away"), (2, "quick brown fox jumps over the lazy dog and runs"), (3, "one"), (4, "Line TWO"), (5, None), (6, ""), (7, " -- "), (None, "nobody knows this text at all but me and you"), (8, "same same same same same same same same same same same"), (9, "naïve café ÉTÉ"), (9, "w976 w0 w1 w2 w3 w4 w5 w6 w7"), (10, "É")]


def test_awkward(spark):
    """Nulls, empty and very long texts, repeated rows, items that share windows or ids, short items, clashing columns."""
    docs = brute.awkward(spark)
    for name in ("n_hit", "windows", "items", "size", "class"):
        docs = docs.withColumn(name, F.lit("own"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("size", F.lit("own"))
    rows = [(r[0], r[1]) for r in brute.AWKWARD] + [(20, "the quick brown fox jumps over the lazy dog"), (21, "x The Quick Brown Fox jumps over the lazy dog and runs y"), (22, "ÉTÉ naïve café ÉTÉ"), (23, "twone one_two one-two ONE")]
    docs = docs.unionByName(spark.createDataFrame(rows[-4:], "doc_id long, text string"), allowMissingColumns=True)
    done = contamination.contaminated(docs, items)
    assert got(done) == wanted(rows, ITEMS)
    assert set(done.columns) == {*docs.columns, "n_words", "n_hit", "windows", "items"} - {"text"}
    assert done.where("doc_id = 5").first()["size"] == "own"
    none = contamination.contaminated(docs, items.where("false"))
    assert none.count() == len(rows) and none.where("n_hit > 0 OR size(items) > 0").count() == 0
    assert contamination.contaminated(docs.where("false"), items).count() == 0


@pytest.mark.parametrize("bits", [None, 64])
def test_planted_passages(spark, monkeypatch, bits):
    """Passages of few different words, in texts and items of all lengths; with a filter that lets everything through too."""
    if bits:
        monkeypatch.setattr(contamination, "LEAST_BITS", bits)
        monkeypatch.setattr(contamination, "MOST_BITS", bits)
    chance = random.Random(13)
    some = lambda n, k: " ".join(chance.choices([f"v{i}" for i in range(k)], k=n))
    items = [(i, some(chance.randint(0, 30), 3 if i % 2 else 200)) for i in range(60)]
    docs = []
    for i in range(200):
        parts = [some(chance.randint(0, 40), 200)]
        for _ in range(chance.randint(0, 3)):
            w = items[chance.randrange(60)][1].split()
            a = chance.randint(0, len(w))
            parts += [" ".join(w[a : a + chance.randint(0, 15)]), some(chance.randint(0, 20), 3)]
        docs.append((i, " ".join(parts)))
    done = contamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got(done) == wanted(docs, items)


def test_every_window_elects_one_of_its_runs():
    """Equal windows elect equal runs wherever they stand."""
    chance = random.Random(5)
    texts = [" ".join(chance.choices("ab", k=n)) for n in (0, 3, 9, 10, 11, 200)]
    hashes, ends = word_hashes(pa.array(texts, pa.string()), fold=True, letters=ALNUM)
    start, prints = contamination.elected(hashes, ends)
    assert len(start) == sum(max(0, n - 9) for n in (0, 3, 9, 10, 11, 200))
    grams, seen = contamination.rolled(hashes, contamination.GRAM), {}
    for s, p in zip(start, prints, strict=True):
        assert p in grams[s : s + 5]
        assert seen.setdefault(tuple(hashes[s : s + 10]), p) == p
    assert contamination.may_be(np.arange(10, dtype=np.uint64), np.array([0b101], np.uint64)).tolist() == [True, False, True] + [False] * 7
