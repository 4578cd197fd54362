"""Plain-Python versions of the operators, and small awkward tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LONG = " ".join(f"w{i % 977}" for i in range(30_000))
SAME = "the quick brown fox jumps over the lazy dog and runs away from here to there until night falls upon us all again"
#: doc_id, text, lang, source, n_chars, and columns whose names clash with the operators' own.
AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", None, "b", 5),
    (4, SAME, "en", "a", 1),
    (5, SAME, "en", "b", 1),
    (6, SAME + " x y", "fr", "b", 1),
    (7, SAME, "en", None, 1),
    (7, SAME, "en", None, 1),
    (8, LONG, "en", "a", 1),
    (9, "one", "en", "a", 1),
    (10, "same same same same " * 40, "de", "c", 1),
    (11, "same same same same " * 40, "de", "c", 1),
    (12, "line one here\nline two\nline one here\n\nNaïve café ÉTÉ <|endoftext|> 中文 don't 123", "en", "b", 1),
    (None, SAME, "en", "a", 1),
    (None, "nobody knows this text at all but me and you", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in ("token_ids", "kept_text", "n_words", "kept", "n_dropped", "score", "_key", "rank"):
        docs = docs.withColumn(name, F.lit("own"))
    return docs


def passages(rows, size=20):
    """{(doc_id, text): (n_words, kept words)} by windows, ids in order, null last."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    places = defaultdict(set)
    for doc, text in order:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = (doc is None, doc or 0, i)
            window = tuple(w[i : i + size])
            if first.setdefault(window, key) > key:
                first[window] = key
            places[doc, text].add((i, window))
    out = {}
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i, window in places[doc, text]:
            if first[window] < (doc is None, doc or 0, i):
                gone |= set(range(i, i + size))
        out[doc, text] = len(w), [x for k, x in enumerate(w) if k not in gone]
    return out


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def links(rows):
    """{doc_id: linked doc_ids} of rows with distinct ids, and {doc_id: least id of its component}."""
    sets = {i: shingles(t) for i, t in rows}
    near = defaultdict(set)
    by = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by[x].add(i)
    for i, s in sets.items():
        for j in set().union(*(by[x] for x in s)) if s else ():
            k = len(s & sets[j])
            if j != i and 5 * k >= 4 * (len(s) + len(sets[j]) - k):
                near[i].add(j)
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in near:
            least = min([root[i], *(root[j] for j in near[i])])
            if least < root[i]:
                root[i], changed = least, True
    return near, root


def metrics(text):
    w = words(text)
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(len(w) - 2):
        if runs[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
