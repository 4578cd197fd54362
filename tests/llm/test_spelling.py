"""Spelling variants against brute force: tables, words of few letters and of all lengths."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tracewell.llm import queries, spelling  # noqa: E402
from tracewell.llm.common import table  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, every=199, least=6, least_n=5):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least_n}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def all_links(counts):
    return {w: {x for x in counts if near(w, x)} for w in counts}


def some_links(counts):
    """The same for words of six symbols and more: near ones share their first or their last half, but for one place."""
    by, links = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in {len(w) // 2 - 1, len(w) // 2}:
            by["a", w[:k]].add(w), by["z", w[len(w) - k :]].add(w)
    for group in by.values():
        group = sorted(group)
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if near(a, b):
                    links[a].add(b), links[b].add(a)
    return links


def wanted(counts, links, ratio=5):
    form = {}
    for w, n in counts.items():
        best = min(links[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), counts.get(form[w])))
    return sorted(out)


def of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_query(spark, sf):
    got = of(queries.op12_spelling_variants(spark, sf))
    counts = counted([(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()])
    assert got == wanted(counts, some_links(counts))
    assert sum(r[1] is not None for r in got) > 5


def test_words_awkward(spark):
    docs = brute.awkward(spark)
    rows = [(r[0], r[1]) for r in brute.AWKWARD]
    for every in (None, 3):
        got = {r.word: r.n for r in spelling.words(docs, least_symbols=2, least_n=1, drop_every=every).collect()}
        assert got == counted(rows, every, 2, 1)
    text = "ÀÉ×÷ß ÀÉ×÷ß àé×÷ß IJKijkİ xĀy"
    assert spelling.words(spark.createDataFrame([(None, text)], "doc_id long, text string"), least_symbols=1, least_n=1).count() == 5
    assert spelling.variants(spelling.words(docs.where("false"))).count() == 0


def made_up(seed):
    """Words of few letters, and of all lengths about a middle, with many near ones; counts with ties and chains of forms."""
    chance = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdeéñ÷"
    pool = {"".join(chance.choices(letters, k=chance.randint(1, 9))) for _ in range(200)}
    for _ in range(200):
        w = chance.choice(sorted(pool))
        i = chance.randint(0, len(w))
        pool.add(chance.choice([w[:i] + chance.choice(letters) + w[i:], w[:i] + w[i + 1 :] or "a", w[:i] + chance.choice(letters) + w[i + 1 :]]))
    return {w: chance.choice([1, 1, 5, 5, 25, 130, 700, 4000]) for w in pool}


@pytest.mark.parametrize(("seed", "levels"), [(1, 32), (2, 32), (3, 6), (4, 6)])
def test_made_up_words(spark, monkeypatch, seed, levels):
    """By the trie alone, and with words of 5 and more symbols by their deletions."""
    monkeypatch.setattr(spelling, "LEVELS", levels)
    counts = made_up(seed)
    got = of(spelling.variants(spark.createDataFrame(sorted(counts.items()), "word string, n long")))
    assert got == wanted(counts, all_links(counts))


def test_long_words_and_chains(spark):
    """Very long words differ at any place; a word's root is the last of its chain."""
    a = "abcdefghij" * 300
    counts = {a: 50, a[1:]: 10, a[:-1]: 9, a[:1500] + "z" + a[1501:]: 8, a + "a": 1, "a" * 31: 100, "a" * 32: 20, "a" * 33: 4, "aaaaaaz": 3, "aaaaaa": 5**4, "aaaaab": 5**3, "aaaabb": 5**2, "aaabbb": 5, "aabbbb": 1}
    got = {r[0]: r for r in of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert {w: got[w][1] for w in (a, a[1:], a[:-1], a + "a")} == {a: None, a[1:]: a, a[:-1]: a, a + "a": a} and got[a][4] == 4
    assert got["a" * 32][1:3] == ("a" * 31, "a" * 31) and got["a" * 33][1:3] == ("a" * 32, "a" * 31)
    assert got["aabbbb"][1:3] == ("aaabbb", "aaaaaa") and got["aaaaaaz"][1] == "aaaaaa"
