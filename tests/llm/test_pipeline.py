"""The pipeline, stage by stage, against what each stage has to do with its input."""

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from tracewell.llm import jaccard_join, line_dedup  # noqa: E402
from tracewell.llm.common import stage, table  # noqa: E402


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, rows = docs.columns, docs.collect()
    steps = [f for _, f in P.STAGES]
    kept = stage(steps[0](spark, docs, sf), "t0")
    ids = {r.doc_id for r in kept.collect()}
    base = {r.doc_id for r in rows if (m := brute.metrics(r.text))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    assert ids <= base and len(ids) > 0.9 * len(base)
    lines = stage(steps[1](spark, kept, sf), "t1")
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    single = stage(steps[2](spark, lines, sf), "t2")
    _, root = brute.links([(r.doc_id, r.text) for r in lines.collect()])
    assert {r.doc_id for r in single.collect()} == {i for i, r in root.items() if i == r}
    mixed = stage(steps[3](spark, single, sf), "t3")
    for df in (kept, lines, single, mixed):
        assert df.columns == columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 3
    last = steps[4](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in last) == copies
    assert all(r.n_tokens == len(r.token_ids) > 0 for r in last)


def test_run(spark, sf):
    assert P.run(spark, sf).count() > 100


def tables(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_near_copies_keep_their_text(spark):
    """By classes of similar texts, lines that only near copies share are no boilerplate; lines that other texts share go."""
    some = lambda seed, n: " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 100_003}" for i in range(n))
    body, banner = [some(1, 60), some(2, 60)], "banner of this site"
    rows = [(i, "\n".join([*body, f"mark {i}", banner]), "en", "s", 1) for i in range(2)]
    rows += [(i, "\n".join([some(10 + i, 60), some(50 + i, 60), banner]), "en", "s", 1) for i in range(2, 30)]
    rows += [(100 + i, r[1], "en", None, 1) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    done = line_dedup.dedup_texts(docs, once=True, small=True, null_site=True, classes=jaccard_join.classes(docs))
    assert done.columns == docs.columns
    assert {r.doc_id: r.text for r in done.collect()} == {i: text.removesuffix("\n" + banner) for i, text, *_ in rows}


def test_stages_on_awkward_tables(spark, tmp_path):
    """Every stage keeps the columns of awkward tables and what its docstring says of their rows, and takes an empty table to an empty one; so does run."""
    odd = brute.awkward(spark)
    none = spark.createDataFrame([], brute.SCHEMA)
    path = tables(spark, tmp_path / "odd", odd)
    good = [i for i, t, *_ in brute.AWKWARD if (m := brute.metrics(t))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    kept = {name: f(spark, odd, path) for name, f in P.STAGES}
    assert all(df.columns == odd.columns for name, df in list(kept.items())[:-1])
    ids = [sorted((r.doc_id for r in df.select("doc_id").collect()), key=str) for df in kept.values()]
    every = sorted((r[0] for r in brute.AWKWARD), key=str)
    assert ids[0] == sorted(good, key=str) and ids[1] == every and ids[4] == every
    assert set(ids[2]) == {1, 2, 3, 4, 8, 9, 10, 12, None} and set(ids[3]) <= set(every)
    assert {r.doc_id: r.text for r in kept["line dedup"].where("doc_id IN (1, 2, 8)").collect()} == {1: None, 2: "", 8: brute.LONG}
    empty = tables(spark, tmp_path / "none", none)
    for _, f in P.STAGES:
        assert f(spark, none, empty).count() == 0
    assert P.run(spark, empty).count() == 0 and P.run(spark, path).select("n_tokens").collect()
