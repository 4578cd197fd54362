"""The ten operators against brute force, on the smallest tables and on awkward ones."""

import math
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tracewell.llm import block_search, bpe_trie, jaccard_join, license_scan, line_dedup, lm_scoring, mixing, quality_rules, queries, rans_files, substring_dedup  # noqa: E402
from tracewell.llm.common import shared_dir, table  # noqa: E402
from tracewell.llm.components import connected  # noqa: E402

WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return brute.awkward(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


# 1: mixing


def water_filling(sizes, weights, most):
    """Targets by resharing what is over the limit until nothing is."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        new = {i for i in range(len(sizes)) if i not in capped and left * weights[i] / free > most * sizes[i]} if free else set()
        if not new:
            return [most * sizes[i] if i in capped else left * weights[i] / free for i in range(len(sizes))]
        capped |= new


def test_mix(spark, sf, docs):
    got = queries.op1_mix_sources(spark, sf).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in queries.op1_mix_sources(spark, sf).collect()}
    source = {r.doc_id: (r.source, len(brute.words(r.text))) for r in docs.collect()}
    size, taken, target, longest = Counter(), Counter(), {}, Counter()
    for r in got:
        s, n = source[r.doc_id]
        assert r.size == n and r.taken <= 3 * n and (n == 0 or r.taken % n == 0)
        size[s] += n
        taken[s] += r.taken
        target[s] = r.target
        longest[s] = max(longest[s], n)
    names = sorted(size)
    wanted = water_filling([size[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))], 3)
    for s, w in zip(names, wanted, strict=True):
        assert target[s] == pytest.approx(w)
        assert abs(taken[s] - w) <= longest[s] / 2  # ten documents a source
        assert longest[s] > 0.2 * w or abs(taken[s] - w) < 0.1 * w
    assert len(got) == len(source)


def test_mix_limits_and_levels(spark):
    """Small sources are limited; thousands of documents need several levels of the tree."""
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "c").when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"))
    mixed = mixing.mix(many).groupBy("source").agg(F.max("source_size").alias("size"), F.max("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most"))
    got = {r.source: r for r in mixed.collect()}
    assert got["c"].target == 3 * got["c"].size == got["c"].taken
    assert got["b"].target == pytest.approx(2 * got["a"].target)
    assert all(abs(r.taken - r.target) <= 17 and r.most <= 3 for r in got.values())


def test_mix_expectation(spark):
    """Over many seeds each document is taken as often as its share says."""
    sizes = [5, 6, 7, 8] * 5
    few = spark.createDataFrame([(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(99, "w " * sum(sizes), "b")], "doc_id long, text string, source string")
    total = Counter()
    for seed in range(12):
        for r in mixing.mix(few, seed=seed).where("source = 'a'").collect():
            total[r.doc_id] += r.copies
            share = r.target / r.source_size
    assert share == pytest.approx(2 / 3)
    assert all(2 <= total[i] <= 12 for i in range(20)) and sum(total.values()) == pytest.approx(12 * 20 * 2 / 3, rel=0.05)


def test_mix_awkward(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(brute.AWKWARD) and all(0 <= r.copies <= 3 for r in got)
    again = mixing.repeat(odd)
    assert again.columns == odd.columns
    assert again.count() == sum(r.copies for r in got)
    assert mixing.mix(none).count() == 0 and mixing.repeat(none).count() == 0


# 2: substring dedup


def removed(df):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()]


def test_passages(docs, rows):
    wanted = brute.passages(rows)
    got = removed(substring_dedup.remove_repeats(docs))
    assert sum(r[2] for r in got) > 0
    assert sorted(got) == sorted((i, n, n - len(kept), " ".join(kept)) for (i, _), (n, kept) in wanted.items())


@pytest.mark.parametrize("group", [1, 3])
def test_passages_by_longer_prefixes(docs, rows, monkeypatch, group):
    """1: all that repeats is extended to whole windows; 3: groups of all lengths."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    wanted = brute.passages(rows)
    got = removed(substring_dedup.remove_repeats(docs))
    assert sorted(got) == sorted((i, n, n - len(kept), " ".join(kept)) for (i, _), (n, kept) in wanted.items())


def test_suffixes_of_frequent_prefixes_are_few_rows():
    """A suffix is a row for each of its first longer prefixes, two at most, whatever windows it has; all windows are in there."""
    text = " ".join(f"w{i}" for i in range(60)).encode()
    every = (1 << substring_dedup.REST + 1) - 1
    spans = [(20 << 16) | every, (40 << 16) | 0b101]
    packed = substring_dedup.zstandard.ZstdCompressor().compress(text)
    docs = pa.RecordBatch.from_arrays([pa.array([b"k"]), pa.array([7]), pa.array([packed]), pa.array([spans])], names=["key", "doc", "__tw_packed", "spans"])
    rows = pa.Table.from_batches(substring_dedup._windows([docs])).to_pylist()
    assert len(rows) == 3
    for span in spans:
        here = [r for r in rows if r["place"] == span >> 16]
        for some in (here, [f for r in here for f in r["finer"]], [w for r in here for f in r["finer"] for w in f["finer"]]):
            assert sum(x["mask"] for x in some) == span & 0xFFFF
    assert len({(w["name"], w["check"]) for r in rows for f in r["finer"] for w in f["finer"]}) == 17


@pytest.mark.parametrize("group", [1, 4096])
def test_passages_of_one_id(spark, monkeypatch, group):
    """Equal places of rows with one id are not earlier than each other, also where their other windows differ."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    w = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    rows = [(5, f"{w(0, 30)} x"), (5, f"{w(0, 25)} {w(100, 25)}"), (9, f"y {w(0, 30)}"), (None, w(100, 25)), (3, w(200, 22)), (5, f"{w(0, 19)} z {w(200, 22)}")]
    wanted = brute.passages(rows)
    got = removed(substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(got, key=key) == sorted(((i, n, n - len(kept), " ".join(kept)) for (i, _), (n, kept) in wanted.items()), key=key)


def test_longer_prefixes_lie_in_their_windows():
    before = np.arange(substring_dedup.REST + 1)
    for length in range(substring_dedup.PREFIX, substring_dedup.WINDOW + 1):
        left = substring_dedup.to_left(before, length)
        assert (left >= 0).all() and (left <= before).all() and (left <= length - substring_dedup.PREFIX).all()
        assert (length - left <= substring_dedup.WINDOW - before).all()
    assert (substring_dedup.to_left(before, substring_dedup.WINDOW) == before).all()


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_own_repeats(letters):
    rng = np.random.default_rng(letters)
    words = np.tile(rng.integers(1, letters + 1, 150), 2)
    words = np.concatenate([words, rng.integers(1, letters + 1, 100)]).astype(np.uint64)
    seen, wanted = set(), []
    for i in range(len(words) - substring_dedup.WINDOW + 1):
        window = tuple(words[i : i + substring_dedup.WINDOW])
        if window in seen:
            wanted.append(i)
        seen.add(window)
    assert substring_dedup.own_repeats(words).tolist() == wanted
    assert len(substring_dedup.own_repeats(words[:19])) == len(substring_dedup.own_repeats(words[:0])) == 0


@pytest.mark.parametrize("group", [1, 3, 4096])
def test_passages_awkward(odd, none, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rows = [(r[0], r[1]) for r in brute.AWKWARD]
    wanted = brute.passages(rows)
    out = substring_dedup.remove_repeats(odd)
    assert "token_ids" in out.columns and out.columns.count("n_words") == 1
    assert sorted(map(str, removed(out))) == sorted(str((i, wanted[i, t][0], wanted[i, t][0] - len(wanted[i, t][1]), " ".join(wanted[i, t][1]))) for i, t in rows)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_suffix_tree_finds_repeats_of_many_copies():
    rng = np.random.default_rng(1)
    words = rng.integers(1, 4, (300, 2 * substring_dedup.REST)).astype(np.uint64)
    doc, span = rng.integers(0, 50, 300), (rng.integers(0, 9, 300) << 16) | ((1 << substring_dedup.REST + 1) - 1)
    prefix = rng.integers(0, 2, 300)
    mask = substring_dedup.repeats(prefix, doc, span, words)
    for j in range(substring_dedup.REST + 1):
        first = {}
        name = [(prefix[i], tuple(words[i, : substring_dedup.REST - j]), tuple(words[i, substring_dedup.REST : substring_dedup.REST + j])) for i in range(300)]
        for i in range(300):
            first[name[i]] = min(first.get(name[i], (99, 99)), (doc[i], span[i] >> 16))
        for i in range(300):
            assert bool(mask[i] >> j & 1) == ((doc[i], span[i] >> 16) > first[name[i]])


# 3: LM scoring


def test_difference_of_models(spark, sf):
    got = queries.op3_lm_difference(spark, sf).collect()
    labels = {r.doc_id: (r.quality, r.toxic) for r in table(spark, sf, "labels").collect()}
    good = [r.score for r in got if labels.get(r.doc_id) == (1, 0)]
    bad = [r.score for r in got if labels.get(r.doc_id, (1, 0))[0] == 0]
    assert np.median(good) < np.median(bad)  # each without its own counts


def test_losses(spark):
    """Losses of a small corpus against counts in dictionaries."""
    texts = ["a b a b c", "A b d", "x y", "", None, "a b"]
    target = [True, True, False, False, None, False]
    docs = spark.createDataFrame([(i, t, g, "own") for i, (t, g) in enumerate(zip(texts, target, strict=True))], "doc_id long, text string, good boolean, score string")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, F.col("good")).collect()}
    split = [(t or "").lower().split() for t in texts]
    pairs = [Counter(zip(["<s>", *w], w, strict=False)) for w in split]
    before = [Counter((["<s>", *w])[: len(w)]) for w in split]
    single = [Counter(w) for w in split]
    a, b, c = lm_scoring.MIX
    places = 1 + len({x for w in split for x in w})
    for i, w in enumerate(split):
        if not w:
            assert got[i].n_tokens == 0 and got[i].score is None
            continue
        for name, group in (("background_loss", range(6)), ("target_loss", [j for j in range(6) if target[j]])):
            others = [j for j in group if j != i]
            n = sum(len(split[j]) for j in others)
            loss = 0
            for x, y in zip(["<s>", *w], w, strict=False):
                context = sum(before[j][x] for j in others)
                word = sum(single[j][y] for j in others) / max(1, n)
                p = a * sum(pairs[j][x, y] for j in others) / context + b * word if context else (a + b) * word
                loss -= math.log(p + c / places if n else 1 / places)
            assert got[i][name] == pytest.approx(loss / len(w))
        assert got[i].score == pytest.approx(got[i].target_loss - got[i].background_loss)


@pytest.mark.parametrize(("good", "before"), [([True, False], "a"), ([True, False], "zz"), ([False, False], "a")])
def test_probabilities_sum_to_one(spark, good, before):
    """Over the whole vocabulary and the place of unseen words, after a known and an unknown context, for both models and without target documents."""
    rows = [(i, t, g) for i, (t, g) in enumerate(zip(["a b a a", "b a b"], good, strict=True))] + [(10, "zz", False)]
    sums, places = [0.0, 0.0], 4  # a, b, zz and the unseen
    for word in ("", "a", "b", "zz"):  # without a word first: what the context itself costs
        docs = spark.createDataFrame([*rows, (9, f"{before} {word}", False)], "doc_id long, text string, good boolean").coalesce(1)
        got = lm_scoring.cross_entropy_difference(docs, F.col("good")).where("doc_id = 9").first()
        own = got.target_loss, got.background_loss
        if word:
            sums = [s + math.exp(one - 2 * two) for s, one, two in zip(sums, alone, own, strict=True)]
        else:
            alone = own
    unseen = [(lm_scoring.MIX[2] if any(good) else 1) / places, lm_scoring.MIX[2] / places]
    assert [s + u for s, u in zip(sums, unseen, strict=True)] == pytest.approx([1, 1])


def test_lm_awkward(spark, odd, none):
    before = {t.name for t in spark.catalog.listTables()}
    got = lm_scoring.cross_entropy_difference(odd, F.lit(None).cast("boolean"))
    assert got.count() == len(brute.AWKWARD) and got.columns.count("score") == 1
    places = 1 + len({x for r in brute.AWKWARD for x in brute.words((r[1] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))})
    for r in got.select("n_tokens", "target_loss", "background_loss", F.col("score").alias("s")).collect():
        if r.n_tokens:
            assert r.target_loss == pytest.approx(math.log(places)) and r.s == pytest.approx(r.target_loss - r.background_loss)
        else:
            assert r.target_loss is None and r.s is None
    assert {t.name for t in spark.catalog.listTables()} == before
    assert lm_scoring.cross_entropy_difference(none, F.lit(True)).count() == 0


def test_losses_of_many_words(spark, monkeypatch):
    """More pairs and words than any fixed model had buckets (2^20 and 2^18), over several slices: every n-gram is counted apart."""
    monkeypatch.setattr(lm_scoring, "SLICE", 1 << 20)
    texts = [" ".join(f"w{(i * 60_000 + j) % 600_000}" for j in range(60_000)) for i in range(20)]
    texts.append("w5 w6 rare w5")
    docs = spark.createDataFrame([(i, t, i >= 18) for i, t in enumerate(texts)], "doc_id long, text string, good boolean").repartition(3)
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, F.col("good")).collect()}
    a, b, c = lm_scoring.MIX
    total = 1_200_000
    places = 600_000 + 2  # w0 to w599999, rare, and the unseen
    seen = a + b * 1 / (total + 4 - 60_000) + c / places  # each pair and word is in one other document
    # The first word of document 12 follows the start mark, as it does in document 2 out of 20 others.
    first = a / 20 + b / (total + 4 - 60_000) + c / places
    assert got[12].background_loss == pytest.approx(-(math.log(first) + 59_999 * math.log(seen)) / 60_000, abs=1e-9)
    p = [b * 2 / total + c / places, a + b * 2 / total + c / places, c / places, (a + b) * 0 + (a + b) * 2 / total + c / places]
    assert got[20].background_loss == pytest.approx(-sum(map(math.log, p)) / 4, abs=1e-9)


# 4: Jaccard join


def test_join(docs, rows):
    near, root = brute.links(rows)
    got = {r.doc_id: r for r in jaccard_join.similar(docs).collect()}
    assert sum(map(len, near.values())) > 0
    for i, _ in rows:
        assert (got[i].class_id, got[i].n_links) == (root[i], len(near[i])), i


def edits(n, seed=3):
    """Many texts that differ from one in a word or two, and from each other little."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.integers(0, 150, 1 + i % 3):
            w[k] = f"e{rng.integers(0, 50)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("limit", [8, 1024])
def test_large_group(spark, monkeypatch, limit):
    """A group of near copies, in one bucket and in buckets that are split, sampled again and searched in blocks."""
    monkeypatch.setattr(jaccard_join, "LIMIT", limit)
    rows = edits(60) + [(100 + i, f"u{i} " + " ".join(f"passage{k}" for k in range(30)) + f" v{i} " * 3) for i in range(40)]
    near, root = brute.links(rows)
    got = {r.doc_id: r for r in jaccard_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: (got[i].class_id, got[i].n_links) for i, _ in rows} == {i: (root[i], len(near[i])) for i, _ in rows}


@pytest.mark.parametrize("depth", [1, 3])
def test_shared_passage(spark, monkeypatch, depth):
    """Texts that share a passage and little else, some with near copies: their buckets are split, and searched in blocks after the last level."""
    monkeypatch.setattr(jaccard_join, "LIMIT", 8)
    monkeypatch.setattr(jaccard_join, "DEPTH", depth)
    rng = np.random.default_rng(11)
    passage = [f"passage{k}" for k in range(40)]
    rows = []
    for i in range(120):
        own = passage + [f"w{k}" for k in rng.integers(0, 5000, 200)]
        rows += [(10 * i + k, " ".join([*own[: 100 + 40 * k], f"changed{k}", *own[101 + 40 * k :]])) for k in range(1 + (i % 10 == 0) * 2)]
    near, root = brute.links(rows)
    assert sum(map(len, near.values())) == 12 * 6
    got = {r.doc_id: r for r in jaccard_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: (got[i].class_id, got[i].n_links) for i, _ in rows} == {i: (root[i], len(near[i])) for i, _ in rows}


def test_join_awkward(odd, none):
    got = [tuple(r) for r in jaccard_join.similar(odd).collect()]
    assert len(got) == len(brute.AWKWARD)
    by = defaultdict(list)
    for r in got:
        by[r[0]].append(r)
    assert by[5][0][1:4] == (4, 4, 5)  # copies: 4, 7, 7 and the one without an id; link: 6
    assert by[6][0][1] == 4 and by[2] == [(2, 2, 2, 0, 0)] and by[10][0][1] == by[11][0][1] == 10
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 8, 9, 10, 12, None}
    assert jaccard_join.similar(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, 5), (7, 6), (6, 8), (130, 3), (None, 4)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 3 for i in range(100, 131)}, 3: 3, 6: 6, 7: 6, 8: 6}


# 5: token files


def check_files(spark, df, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    read = rans_files.read(spark, path).join(rans_files.starts(rans_files.read_index(spark, path)), ["part", "block"])
    got = [(r.doc_id, r.block_start + r.offset, bytes(r.ids)) for r in read.collect()]
    got.sort(key=lambda r: r[1])
    start = 0
    assert [r[0] for r in got if r[0] is not None] == sorted(r.doc_id for r in df.collect() if r.doc_id is not None)
    wanted = Counter((r.doc_id, np.array(t.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for r in df.collect())
    assert Counter((r[0], r[2]) for r in got) == wanted
    for _, at, ids in got:
        assert at == start
        start += len(ids) // 4


def test_files(spark, docs, odd, none, monkeypatch):
    monkeypatch.setattr(rans_files, "BLOCK_TOKENS", 5000)
    for df in (docs, odd, none):
        path = f"{shared_dir(spark)}/test-files-{id(df)}"
        rans_files.write(df, path, BYTE_BPE)
        check_files(spark, df, path)


def test_crc(spark, sf):
    got = queries.op5_rans_files(spark, sf).orderBy("start").first()
    from tokenizers import Tokenizer

    text = table(spark, sf, "documents").orderBy("doc_id").first().text
    ids = np.array(Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids + [0], "<u4")
    assert (got.start, got.n_tokens, got.ids_crc32) == (0, len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("n", [0, 1, 255, 5000, 300_000])
def test_coder(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n), 50_256)
    freq = rans_files.frequencies(np.bincount(ids, minlength=2)).astype(np.uint64)
    cum = (np.cumsum(freq) - freq).astype(np.uint64)
    symbols = np.repeat(np.arange(len(freq), dtype=np.int32), freq.astype(np.int64))
    lanes, states, offsets, checks, payload = rans_files.pack(ids, freq, cum)
    back = rans_files.unpack(n, lanes, rans_files.STRIDE, states.reshape(-1), offsets, checks, payload, freq, cum, symbols)
    assert (back == ids).all()
    if len(payload):
        payload[len(payload) // 2] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            rans_files.unpack(n, lanes, rans_files.STRIDE, states.reshape(-1), offsets, checks, payload, freq, cum, symbols)


# 6: nearest neighbours


def inner(a, b):
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        total += x * y
    return total


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            scores = sorted({(-inner(v, w), i) for i, w in good if i != q and len(w) == len(v)})
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_nearest(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert found(queries.op6_block_search(spark, sf)) == brute_nearest(rows, 20)


def test_nearest_awkward(spark, monkeypatch):
    monkeypatch.setattr(block_search, "TILE_ROWS", 7)
    monkeypatch.setattr(block_search, "LEAST_NUMBERS", 50)  # several blocks
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(90)]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(100, 160)]  # copies and ties
    rows += [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 2.0]), (280, [float("nan"), 1.0, 1.0]), (300, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (320, [1.0, 2.0]), (340, [5.0, 5.0, 5.0]), (340, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("own"))
    got = found(block_search.nearest(df, F.col("vec_id") % 20 == 0, k=5))
    assert got == {q: v for q, v in brute_nearest(rows, 5).items() if v}
    assert block_search.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_wide_vectors_are_exact():
    rng = np.random.default_rng(4)
    a, b = (np.rint(rng.uniform(-127, 127, (5, 3000))).astype(np.float32) for _ in range(2))
    assert (block_search.product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


# 7: line dedup


def brute_lines(pages, ratio, least):
    """pages: (host, lines) -> kept lines."""
    total, on = Counter(h for h, _ in pages), Counter()
    for h, lines in pages:
        on.update((h, x) for x in set(lines or ()) if brute.WORD.search(x))
    drop = {k for k, n in on.items() if k[0] is not None and total[k[0]] >= least and n > ratio * total[k[0]] and n > 1}
    return [[x for x in lines if (h, x) not in drop] if lines is not None else None for h, lines in pages]


def test_lines(docs):
    rows = docs.select("doc_id", "source", "text").orderBy("doc_id").collect()
    wanted = brute_lines([(r.source, r.text.split("\n")) for r in rows], 0.05, 5)
    got = line_dedup.dedup_texts(docs, ratio=0.05, min_pages=5).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["\n".join(x) for x in wanted]
    assert any(a.text != b.text for a, b in zip(rows, got, strict=True))


def test_pages(spark, sf):
    html = "<html><title>T</title><script>var x='</p>';</script><!-- <p>no</p> --><nav><a href=x>Home</a></nav><p>One <b>bold</b> line<br>Two</p> </html>"
    df = spark.createDataFrame([("HTTP://u:p@A.Test:80/x", html), ("nothing", None)], "url string, html string")
    got = df.select(line_dedup.url_host(F.col("url")), line_dedup.html_lines(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("a.test", ["T", "Home", "One bold line", "Two"]), (None, [])]
    assert queries.op7_line_dedup(spark, sf).count() == table(spark, sf, "pages").count()


def test_lines_awkward(odd, none):
    got = line_dedup.dedup_texts(odd, ratio=0.3, min_pages=2)
    assert got.columns == odd.columns and got.count() == len(brute.AWKWARD)
    wanted = brute_lines([(r[3], None if r[1] is None else r[1].split("\n")) for r in brute.AWKWARD], 0.3, 2)
    assert sorted(str(r.text) for r in got.collect()) == sorted(str(None if x is None else "\n".join(x)) for x in wanted)
    assert line_dedup.dedup_texts(none).count() == 0


def test_copies_keep_their_text(spark):
    """A group of copies of over 5% of a source keeps its text; a line of many distinct texts goes."""
    copy = "first line of the copies\nsecond line of the copies"
    rows = [(i, copy, "s") for i in range(10)] + [(i, f"banner\nbody of {i}", "s") for i in range(10, 40)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_texts(spark.createDataFrame(rows, "doc_id long, text string, source string"), once=True).collect()}
    assert got == {i: copy if i < 10 else f"body of {i}" for i in range(40)}
    few = [(i, copy, "s") for i in range(30)] + [(30, "banner\nbody", "s")]  # two distinct texts
    got = line_dedup.dedup_texts(spark.createDataFrame(few, "doc_id long, text string, source string"), once=True)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(i, t) for i, t, _ in few}


def test_stage_and_query_keep_copies(spark, tmp_path):
    import corpus_pipeline

    copy = "first line of the copies\nsecond line of the copies"
    rows = [(i, copy if i < 5 else f"body of {i}", "en", "s", 1) for i in range(30)]
    got = corpus_pipeline.lines(spark, spark.createDataFrame(rows, brute.SCHEMA), "")
    assert {r.doc_id: r.text for r in got.collect()} == {r[0]: r[1] for r in rows}
    pages = [(i, "http://a.test/", f"<p>{t}</p>") for i, t, *_ in rows]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert all(r.n_dropped == 0 for r in queries.op7_line_dedup(spark, str(tmp_path)).collect())


def test_pages_awkward(spark, tmp_path):
    """Null pages and urls, unclosed tags, a page of a long comment, columns of clashing names, a host of three pages."""
    rows = [(i, "http://a.test/x", f"<p>banner</p><p>body {i}</p>", "own", [1]) for i in range(3)]
    rows += [(10, None, "<p>banner</p>", None, None), (11, "http://a.test/y", None, None, None), (12, "http://b.test", "<script>never closed <p>banner</p>", None, None)]
    rows += [(13, "http://b.test", "<!-- " + "x y " * 50_000 + "<p>last", None, None), (14, "http://b.test", "", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, lines array<int>")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.host, r.n_lines, r.n_dropped) for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()}
    # The page without html is a distinct page of the host: the banner is on 3 of its 4.
    assert got == {**{i: ("a.test", 2, 0) for i in range(3)}, 10: (None, 1, 0), 11: ("a.test", 0, 0), 12: ("b.test", 2, 0), 13: ("b.test", 2, 0), 14: ("b.test", 0, 0)}
    pages.where("page_id < 3").write.parquet(f"{tmp_path}/three/pages.parquet")
    assert all(r.n_dropped == 1 for r in queries.op7_line_dedup(spark, f"{tmp_path}/three").collect())


def test_small_and_null_sources(spark):
    """The stage drops a banner of 19 documents and of two, and those of documents without a source; a line of few stays."""
    import corpus_pipeline

    rows = [(i, f"banner\nbody of {i}" + ("\nsome" if i < 1 else ""), "en", "s", 1) for i in range(19)]
    rows += [(100 + i, f"banner\nbody of {100 + i}", "en", None, 1) for i in range(30)]
    rows += [(200 + i, f"banner\nbody of {200 + i}", "en", "two", 1) for i in range(2)]
    rows += [(300 + i, ("said twice\n" if i < 2 else "") + f"body of {300 + i}", "en", "ten", 1) for i in range(10)]
    rows += [(400 + i, "one text", "en", "", 1) for i in range(3)]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, spark.createDataFrame(rows, brute.SCHEMA), "").collect()}
    assert got == {i: t.removeprefix("banner\n") for i, t, *_ in rows}


# 8: BPE


def test_bpe(spark, docs, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    for df in (docs, odd):
        out = bpe_trie.decode(bpe_trie.encode(df, WORD_BPE), WORD_BPE)
        assert out.columns.count("token_ids") == 1
        for r in out.collect():
            ids = t.encode(r.text or "", add_special_tokens=False).ids
            assert list(r.token_ids) == ids
            assert r.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe_trie.decode(bpe_trie.encode(none, WORD_BPE), WORD_BPE).count() == 0


STRINGS = ["  a", " a ", "a\x1cb  c\x85 d \n e", "x <|endoftext|> y", "it's  they'll\n\n\nfoo   bar \t x ", "日本 語 テスト 😀 é ñandú Ⅷ x²", "a　 b   c", "\n", "   ", "don’t a_b __ 1a2 ½x ŉ", "\x00 a\x01b", "x" * 5000 + " y"]


def test_token_strings():
    """Texts cut and put together by chunks and words have the ids of whole texts."""
    from tokenizers import Tokenizer

    t, known = Tokenizer.from_file(BYTE_BPE), rans_files.Tokens(BYTE_BPE)
    for texts in (STRINGS, [None, *STRINGS, ""], ["plain text"], []):
        assert [x.tolist() for x in known.encode(pa.array(texts, pa.string()))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("text", ["ΣΑΣ ὈΔΥΣΣΕΎΣ", "é 中文 \x1c\x1f \x85 ٣ ½ İ ß 🐱", "'''s don't I'LL", "a" * 300, "<|startoftext|>x<|endoftext|>", " a　b\xa0c", "x</w>y"])
def test_bpe_strings(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(WORD_BPE).encode(text, add_special_tokens=False).ids
    assert bpe_trie.encoder(WORD_BPE).encode(pa.array([text]))[0].as_py() == ids


# 9: quality rules


def test_metrics(docs, odd, none):
    for df, n in ((docs, 200), (odd, len(brute.AWKWARD))):
        got = quality_rules.metrics(df).select("text", *quality_rules.METRICS[:5]).collect()
        assert len(got) == n
        for r in got:
            assert tuple(r)[1:] == brute.metrics(r.text)
    assert quality_rules.metrics(none).count() == 0


def test_binomial_tail(spark):
    for n, k, p in ((100, 0, 0.05), (400, 8, 0.05), (1000, 20, 0.05), (50, 3, 0.05)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules._tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), p)).first()[0]
        assert got == (pytest.approx(exact) if k < n * p else 1.0)


def test_cutoffs(spark):
    """Cutoffs are used where the holdout proves them and nowhere else; copies of a text prove as much as one."""
    text = " ".join(f"w{i}" for i in range(100))
    junk = " ".join(f"w{i}%%%" for i in range(100))
    rows = [(i, f"{text} x{i}", "big") for i in range(600)] + [(3000 + i, f"{junk} x{i}", "big") for i in range(60)] + [(4000 + i, f"{text} x{i}", "small") for i in range(20)] + [(5000 + i, f"{junk} x{i}", "small") for i in range(20)]
    rows += [(6000 + i, text, "copies") for i in range(600)] + [(7000 + i, f"{junk} x{i}", "copies") for i in range(60)] + [(8000, junk, "copies"), (8001, junk, "copies")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 0 if junk in t and i != 8000 else 1) for i, t, _ in rows] + [(None, 1), (99_999, 0)], "doc_id long, quality int")
    cut = {(r.stratum, r.rule): r for r in quality_rules.thresholds(quality_rules.metrics(docs), labels).collect()}
    assert set(cut) == {("big", "symbols")}
    assert (cut["big", "symbols"].n_good, cut["big", "symbols"].n_lost, cut["big", "symbols"].n_caught) == (600, 0, 60)
    kept = quality_rules.quality_filter(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 60


def test_risk_holds(spark):
    """Of 100 strata whose cutoffs would lose a little more than their share none gets one; where much less is lost all do."""
    share = quality_rules.RISK * quality_rules.SHARES["symbols"]
    n = 4000
    rows = spark.range(200 * n).select("id", (F.col("id") % 200).cast("string").alias("lang"), F.expr(f"id >= {200 * (n - 100)}").alias("bad"), F.rand(3).alias("u"))
    loss = F.when(F.col("lang").cast("int") < 100, share * 1.05).otherwise(share / 6)
    odd = F.col("bad") | (F.col("u") < loss)
    zero = {c: F.lit(0).cast("bigint") for c in quality_rules.METRICS}
    measured = rows.withColumns(zero | {"n_words": F.lit(100).cast("bigint"), "n_symbols": F.when(odd, 50).otherwise(0).cast("bigint"), "text_key": F.col("id")}).withColumnRenamed("id", "doc_id")
    labels = measured.select("doc_id", F.when(F.col("bad"), 0).otherwise(1).alias("quality"))
    assert {int(r.stratum) for r in quality_rules.thresholds(measured, labels).collect()} == set(range(100, 200))


def test_quality_awkward(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (8, None)], "doc_id long, quality int")
    kept = quality_rules.quality_filter(odd, labels)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t, *_ in brute.AWKWARD if i and (m := brute.metrics(t))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    assert quality_rules.quality_filter(none, labels).count() == 0
    assert quality_rules.quality_filter(none, labels.where("false")).count() == 0


# 10: license scans


def test_licenses(spark, docs, rows, none):
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()}
    lines = {"Apache-2.0": "Licensed under the Apache License, Version 2.0", "MIT": "Released under the MIT License", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3"}
    assert got == {(i, name) for i, t in rows for name, line in lines.items() if t and line in t}
    assert license_scan.scan(none).count() == 0


def test_alignment(spark, odd):
    text = license_scan.TEMPLATES["MIT-permission"]
    w = text.split()
    edited = " ".join(w[:20] + ["and", "very", "much"] + w[20:50] + w[53:])  # words put in and left out
    half = " ".join(w[: len(w) // 2])
    docs = spark.createDataFrame([(1, "intro words " + edited.upper() + " outro"), (2, half), (3, "intro " + text + " middle " * 30 + text), (4, None), (None, text)], "doc_id long, text string")
    got = [r for r in license_scan.scan(docs).collect() if r.license == "MIT-permission"]
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert 0.95 < by[1][0].coverage < 1 and by[1][0].start_word == 2 and by[1][0].start_char == len("intro words ")
    assert 2 not in by and len(by[3]) == 2 and len(by[None]) == 1
    assert all(r.coverage == 1.0 for r in by[3])
    assert license_scan.scan(odd).count() == 0


@pytest.mark.parametrize("name", ["MIT", "CC-BY-NC-4.0", "Apache-2.0", "MIT-permission"])
@pytest.mark.parametrize("apart", [0, 1, 3])
def test_copies_that_follow_one_another(spark, name, apart):
    text = license_scan.TEMPLATES[name]
    n, copies = len(license_scan.WORD.findall(text)), 12
    docs = spark.createDataFrame([(1, "intro " + " ".join([text] + [" ".join(["filler"] * apart + [text])] * (copies - 1)))], "doc_id long, text string")
    got = [(r.start_word, r.end_word, r.coverage) for r in license_scan.scan(docs).collect() if r.license == name]
    assert got == [(1 + i * (n + apart), i * (n + apart) + n, 1.0) for i in range(copies)]


def scanned(text, templates=license_scan.TEMPLATES):
    known = license_scan.index(templates)
    words = license_scan.WORD.findall(text)
    return license_scan.scan_text(known, text, np.array([known.cased(x) for x in words], np.int64), license_scan.COVERAGE)


@pytest.mark.parametrize("name", license_scan.TEMPLATES)
def test_template_finds_itself_only(name):
    """A license whose text is most of another's is named alone."""
    assert [(m[0], m[1]) for m in scanned(f"some words {license_scan.TEMPLATES[name]} and others")] == [(name, 1.0)]


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[-1]))
    return row[-1]


def test_alignment_by_brute_force():
    """Edited copies of templates among noise: each is found, and what a match reports is the longest common subsequence of its span."""
    rng = np.random.default_rng(7)
    templates = {f"t{i}": " ".join(f"w{x}" for x in rng.integers(0, 60, n)) for i, n in enumerate((12, 30, 60, 100))}
    for _ in range(40):
        planted, text = [], []
        for name in rng.choice(list(templates), 3):
            text += [f"n{x}" for x in rng.integers(0, 50, rng.integers(0, 30))]
            words = templates[name].split()
            for at in sorted(rng.choice(len(words), len(words) // 12, replace=False), reverse=True):  # left out, put in or replaced
                words[at : at + 1] = [[], [words[at], "in"], ["other"]][rng.integers(0, 3)]
            planted.append((name, len(text), len(text) + len(words) - 1))
            text += words
        got = scanned(" ".join(text), templates)
        for name, a, b in planted:
            assert any(m[0] == name and m[2] <= b and m[3] >= a for m in got), (name, a, b, got)
        for name, share, a, b, *_ in got:
            own = templates[name].split()
            assert round(share * len(own)) == common(own, text[a : b + 1])
        assert all(x[3] < y[2] for x, y in zip(got, got[1:], strict=False))


def test_thousands_of_copies(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License. " * 3000)], "doc_id long, text string")
    assert license_scan.scan(docs).where("license = 'MIT'").count() == 3000
