"""Removal of repeated passages by prefix-partitioned suffix trees.

Every window of WINDOW words elects the PREFIX words in it with the least hash (the leftmost, of
equals), so equal windows elect the same words at the same place. Only suffixes that start at
elected places are kept: a sparse suffix tree that still holds every window.

1. Each suffix is named by the hash of its prefix. Prefixes are counted over all documents, and
   those that occur once, or in copies of one text only, can't be in a repeat between texts: most
   suffixes end here, at some bytes each.
2. The others are dealt out by prefix. Prefixes of up to GROUP suffixes go to a task as they are;
   more frequent ones are extended to each of LONGER words until a group fits, to the left where a
   window ends with its prefix. A prefix that is too frequent even as a whole window is a leaf of
   the tree: its windows are equal, and their first place is a minimum, combined before the shuffle.
3. A task sorts its suffixes by the words after the prefix; the words that neighbours share (LCP)
   make the suffix tree, and its nodes at each depth are runs of the sorted order. The same is
   done to the left. Two nodes that together span WINDOW words are a repeat, of which
   every place but the first is reported; together these give the maximal repeats.
4. A text's own repeats are the inner nodes of its own suffix tree, grown from 6 to 12 and 20 words.

Words and prefixes are compared by 64-bit hashes; texts, and windows that are leaves, by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_trie import slices
from tracewell.llm.common import stage
from tracewell.llm.word_hash import hashes_of, mix, word_hashes

#: Words in a window, and in the prefixes that partition the suffixes.
WINDOW, PREFIX = 20, 6
#: Words beside the prefix that a window may have on either side.
REST = WINDOW - PREFIX
#: Suffixes of one prefix that a task takes; a prefix of more is extended to each of LONGER words in turn, then to whole windows.
GROUP, LONGER = 4096, (10, 15)
#: Suffixes that a task sorts at once.
SORTED = 100_000
#: Compressed bytes of text that a task works on at once.
SLICE = 1 << 19
#: Place in the order of documents of a null id: after all others.
LAST = (1 << 63) - 1

#: Odd multipliers from a fixed seed, one for each word of a window, for two independent hashes.
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, (2, WINDOW), dtype=np.uint64) | np.uint64(1)


def rolled(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each run of `size` words."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += hashes[i : i + n] * MULTIPLIERS[which, i]
    return mix(total)


def elected(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of the documents whose words stand one after the other: (place, prefix hash, windows).

    Bit j of windows stands for the window that has j words to the left of the prefix. Of equal
    windows of one document only the first is there; the others are found again with the text.
    """
    none = np.zeros(0, np.int64)
    start = np.arange(max(0, len(hashes) - WINDOW + 1))
    doc = np.searchsorted(ends, start, "right")
    ok = ends[doc] - start >= WINDOW if len(start) else np.zeros(0, bool)
    start, doc = start[ok], doc[ok]
    if not len(start):
        return none, none.astype(np.uint64), none
    names = rolled(hashes, WINDOW)[start] ^ mix(doc.astype(np.uint64))
    fresh = np.zeros(len(start), bool)
    fresh[np.unique(names, return_index=True)[1]] = True
    start = start[fresh]
    prefixes = rolled(hashes, PREFIX)
    place = start + np.lib.stride_tricks.sliding_window_view(prefixes, REST + 1)[start].argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    at = place[first]
    return at, prefixes[at], np.bitwise_or.reduceat(np.int64(1) << (place - start), first)


def _suffixes(docs: DataFrame, text: str) -> DataFrame:
    """(prefix, key, span) of every elected suffix; key names the text, span packs its place and its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__tw_text"):
                hashes, ends = word_hashes(part.column("__tw_text"))
                at, prefix, windows = elected(hashes, ends)
                doc = np.searchsorted(ends, at, "right")
                keys = part.column("__tw_key").take(pa.array(doc))
                span = ((at - np.concatenate([[0], ends])[doc]) << 16) | windows
                yield pa.RecordBatch.from_arrays([pa.array(prefix.view(np.int64)), keys, pa.array(span)], names=["prefix", "key", "span"])

    rows = docs.select(F.col("__tw_key"), F.col(text).alias("__tw_text"))
    return rows.mapInArrow(run, "prefix long, key binary, span long")


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """docs with their compressed texts (packed) instead of the texts, which takes less room in a shuffle."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept).schema.add("__tw_packed", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack = zstandard.ZstdCompressor(level=3).compress
            for part in slices(batch, text):
                packed = [pack(x.encode("utf-8", "surrogatepass")) if x else None for x in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(packed, pa.binary())], names=[*kept, "__tw_packed"])

    return docs.mapInArrow(run, schema)


def _unpack(packed: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their suffixes in; each suffix with the words around its prefix out."""
    for batch in batches:
        for i in range(batch.num_rows):
            hashes = hashes_of(_unpack(batch.column("__tw_packed")[i].as_py()))
            spans, prefixes = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("spans", "prefixes"))
            padded = np.concatenate([np.zeros(REST, np.uint64), hashes, np.zeros(WINDOW, np.uint64)])
            at = (spans >> 16) + REST
            for a in range(0, len(at), SORTED):
                some = at[a : a + SORTED, None]
                around = np.concatenate([padded[some + np.arange(PREFIX, WINDOW)], padded[some - 1 - np.arange(REST)]], axis=1)
                n = len(some)
                data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * 16 * REST).tobytes()), pa.py_buffer(around.tobytes())])
                key, doc = (pa.repeat(batch.column(c)[i], n) for c in ("key", "doc"))
                yield pa.RecordBatch.from_arrays([pa.array(prefixes[a : a + n]), key, doc, pa.array(spans[a : a + n]), data], names=["prefix", "key", "doc", "span", "around"])


def tree(keys: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted suffix tree: (order of the suffixes, words that each shares with the one before in it, -1 across keys)."""
    order = np.lexsort([*words.T[::-1], keys])
    shared = np.full(len(order), -1)
    if len(order) > 1:
        same = words[order[1:]] == words[order[:-1]]
        lcp = np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1))
        shared[1:] = np.where(keys[order[1:]] == keys[order[:-1]], lcp, -1)
    return order, shared


def nodes(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """The tree's node at a depth for each suffix."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeats(prefix: np.ndarray, doc: np.ndarray, span: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For each suffix, a bit for each number of words to its left at which its window repeats an earlier one."""
    place = span >> 16
    sequence = np.lexsort([place, doc])  # ascending, so that a node's first member is its first place
    right, left = tree(prefix, around[:, :REST]), tree(prefix, around[:, REST:])
    mask = np.zeros(len(prefix), np.int64)
    for j in range(REST + 1):
        has = sequence[((span >> j) & 1 == 1)[sequence]]
        if len(has) < 2:
            continue
        node = nodes(*right, REST - j)[has] * np.int64(len(prefix) + 1) + nodes(*left, j)[has]
        _, first, member = np.unique(node, return_index=True, return_inverse=True)
        lead = has[first[member]]
        later = (doc[has] != doc[lead]) | (place[has] != place[lead])
        mask[has[later]] |= np.int64(1) << j
    return mask


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by prefix in; (key, place, mask) of those with repeats out. Holds SORTED suffixes and the current prefix's."""
    held: list[pa.Table] = []

    def done(table: pa.Table) -> pa.RecordBatch:
        prefix, doc, span = (table.column(c).to_numpy() for c in ("prefix", "doc", "span"))
        around = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint64).reshape(-1, 2 * REST)
        mask = repeats(prefix, doc, span, around)
        hit = np.flatnonzero(mask)
        key = table.column("key").combine_chunks().take(pa.array(hit))
        return pa.RecordBatch.from_arrays([key, pa.array(span[hit] >> 16), pa.array(mask[hit])], names=["key", "place", "mask"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) >= SORTED:
            table = pa.concat_tables(held)
            prefix = table.column("prefix").to_numpy()
            cut = int(np.searchsorted(prefix == prefix[-1], True))  # the last prefix may go on
            if cut:
                yield done(table.slice(0, cut))
            held = [table.slice(cut)]
    if held:
        yield done(pa.concat_tables(held))


def to_left(before: np.ndarray, length: int) -> np.ndarray:
    """Words to the left of its prefix that an extended prefix of `length` words takes, in windows with `before` words there.

    Equal for as many windows as can be: 0 where the right side has room, and all of them only in whole windows.
    """
    room = WINDOW - length + 1
    return np.minimum(before // room * room, length - PREFIX)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their suffixes of frequent prefixes in; rows NESTED out: a suffix has one for each of its first longer prefixes, not one for each window."""
    step = SORTED // (REST + 1)
    for batch in batches:
        for i in range(batch.num_rows):
            hashes = hashes_of(_unpack(batch.column("__tw_packed")[i].as_py()))
            runs = [(length, rolled(hashes, length)) for length in LONGER]
            whole = [rolled(hashes, WINDOW, which) for which in (0, 1)]
            spans = batch.column("spans")[i].values.to_numpy(zero_copy_only=False)
            for a in range(0, len(spans), step):
                at, before = np.nonzero((spans[a : a + step, None] >> np.arange(REST + 1)) & 1)
                place, bits = (spans[a : a + step] >> 16)[at], np.int64(1) << before
                begins, inner = [], np.arange(len(at))  # the first window of each prefix, from short prefixes to long ones
                new = np.concatenate([[True], at[1:] != at[:-1]])
                for length, _ in runs:
                    left = to_left(before, length)
                    new = new | np.concatenate([[True], left[1:] != left[:-1]])
                    begins.append(np.flatnonzero(new))
                rows = pa.StructArray.from_arrays([*(pa.array(x[place - before].view(np.int64)) for x in whole), pa.array(bits)], names=["name", "check", "mask"])
                for (length, run), first in zip(runs[::-1], begins[::-1], strict=True):
                    left = to_left(before, length)[first]
                    name = mix(run[place[first] - left] + mix(left.astype(np.uint64) + np.uint64(1)))
                    finer = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(inner, first), len(inner)).astype(np.int32)), rows)
                    rows = pa.StructArray.from_arrays([pa.array(name.view(np.int64)), pa.array(np.bitwise_or.reduceat(bits, first)), finer], names=["prefix", "mask", "finer"])
                    inner = first
                key, doc = (pa.repeat(batch.column(c)[i], len(inner)) for c in ("key", "doc"))
                yield pa.RecordBatch.from_arrays([*rows.flatten(), key, doc, pa.array(place[inner])], names=["prefix", "mask", "finer", "key", "doc", "place"])


#: Windows by 128-bit names within their longer prefixes; each mask has the bits of the windows in it.
NESTED = "array<struct<name: bigint, check: bigint, mask: bigint>>"
for _ in LONGER[1:]:
    NESTED = f"array<struct<prefix: bigint, mask: bigint, finer: {NESTED}>>"
NESTED = f"prefix long, mask long, finer {NESTED}, key binary, doc long, place long"


def repeated_places(docs: DataFrame, firsts: DataFrame, text: str = "text") -> DataFrame:
    """(key, places: array of (place, mask)) for texts with windows that an earlier document has: bit j of a mask stands for the window j words before its place.

    docs: with __tw_key (a hash of the text) and __tw_doc (place in the order of ids); firsts: (key, doc, n)
    of each text with its first document, the only one of its copies that is looked at.
    """
    suffixes = stage(_suffixes(docs, text), "elected")
    spot = F.xxhash64("key", "span")  # the same in copies of a text, which don't make a prefix frequent
    counts = suffixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("a"), F.max(spot).alias("b")).where("a <> b").select("prefix", "n")
    shared = stage(suffixes.join(stage(counts, "prefixes"), "prefix").distinct(), "suffixes")
    packed = _packed(docs.select("__tw_key", "__tw_doc", text), text)

    def of(some: DataFrame) -> DataFrame:
        own = some.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("span", "prefix"))).alias("own"))
        own = own.join(firsts.select("key", "doc"), "key")
        rows = packed.join(own, (F.col("__tw_key") == F.col("key")) & (F.col("__tw_doc") == F.col("doc")))
        return rows.select("key", "doc", "__tw_packed", F.col("own.span").alias("spans"), F.col("own.prefix").alias("prefixes"))

    left = stage(of(shared.where(F.col("n") > GROUP)).mapInArrow(_windows, NESTED), "windows")
    grouped = shared.where(F.col("n") <= GROUP).select("prefix", "key", "span")
    for depth, length in enumerate(LONGER):
        if depth:
            left = left.select("key", "doc", "place", F.inline("finer"))
        n = stage(left.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"prefix-{length}")
        left = stage(left.join(n, "prefix").withColumn("finer", F.when(F.col("n") > GROUP, F.col("finer"))), f"windows-{length}")
        grouped = grouped.unionByName(left.where(F.col("n") <= GROUP).select("prefix", "key", F.shiftleft("place", 16).bitwiseOR(F.col("mask")).alias("span")))
        left = left.where(F.col("n") > GROUP).drop("n")
    contexts = of(grouped).mapInArrow(_contexts, "prefix long, key binary, doc long, span long, around binary")
    grown = contexts.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_grow, "key binary, place long, mask long")
    # Equal windows have their prefix at the same place of theirs, so the first window is the one of the first prefix.
    first = left.select("doc", "place", F.inline("finer").alias("name", "check", "bit")).groupBy("name", "check").agg(F.min(F.struct("doc", "place")).alias("first"))
    first = stage(first.groupBy("first.doc", "first.place").agg(F.collect_set(F.struct("name", "check")).alias("first")), "first-windows")
    # A suffix meets the windows that are first where it stands; its others are repeats.
    is_first = lambda w: F.coalesce(F.array_contains("first", F.struct(w["name"].alias("name"), w["check"].alias("check"))), F.lit(False))
    again = F.aggregate("finer", F.lit(0).cast("bigint"), lambda m, w: F.when(is_first(w), m).otherwise(m.bitwiseOR(w["mask"])))
    later = left.join(first, ["doc", "place"], "left").select("key", "place", again.alias("mask")).where("mask <> 0")
    return grown.unionByName(later).groupBy("key").agg(F.collect_set(F.struct("place", "mask")).alias("places"))


def branching(names: np.ndarray) -> np.ndarray:
    """A number for each name that occurs several times, -1 for the others."""
    ordered = np.sort(names)
    several = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(several):
        return np.full(len(names), -1)
    at = np.minimum(np.searchsorted(several, names), len(several) - 1)
    return np.where(several[at] == names, at, -1)


def deeper(node: np.ndarray, step: int) -> np.ndarray:
    """Inner nodes of a text's suffix tree `step` words below `node`: a run repeats only if its first and its last part do."""
    a, b = node[:-step], node[step:]
    both = (a >= 0) & (b >= 0)
    out = np.full(len(a), -1)
    out[both] = branching(a[both] * (node.max(initial=0) + 1) + b[both])
    return out


def own_repeats(hashes: np.ndarray) -> np.ndarray:
    """Starts of windows that also start earlier in their text: the inner nodes of its suffix tree at WINDOW words, but for their first places."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64)
    node = deeper(deeper(branching(rolled(hashes, PREFIX)), PREFIX), WINDOW - 2 * PREFIX)
    at = np.flatnonzero(node >= 0)
    later = np.ones(len(at), bool)
    later[np.unique(node[at], return_index=True)[1]] = False
    return at[later]


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with kept_text (words that are left, joined by one blank) instead of text, n_words and n_removed (long).

    A word goes if a window of WINDOW words that covers it also starts earlier in the input: in a
    document of smaller id, or in the same one before it. A null id comes after all others; rows
    with one id are one document, so equal places of theirs are not earlier than each other. Null
    and empty texts have no words. All rows and other columns stay; columns of the new names
    are replaced. Of copies of a text all but the first go as a whole, without being searched.
    """
    added = ("kept_text", "n_words", "n_removed")
    marked = docs.drop(*added).withColumn("__tw_key", F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))).withColumn("__tw_doc", F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)))
    firsts = stage(marked.groupBy(F.col("__tw_key").alias("key")).agg(F.min("__tw_doc").alias("doc"), F.count(F.lit(1)).alias("n")), "texts")
    places = repeated_places(marked, firsts, text)
    about = stage(firsts.where("n > 1").select("key", "doc").join(places, "key", "full").select(F.col("key").alias("__tw_about"), F.col("doc").alias("__tw_first"), F.col("places.place").alias("__tw_places"), F.col("places.mask").alias("__tw_masks")), "places")
    kept = [c for c in docs.columns if c != text and c not in added]
    joined = _packed(marked, text).join(about, F.col("__tw_key") == F.col("__tw_about"), "left").select(*kept, "__tw_packed", (F.col("__tw_doc") > F.col("__tw_first")).alias("__tw_copy"), "__tw_places", "__tw_masks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__tw_packed", SLICE):
                texts, sizes, gone = [], [], []
                for i, value in enumerate(part.column("__tw_packed").to_pylist()):
                    raw = _unpack(value)
                    words = raw.split()
                    size = len(words)
                    if size >= WINDOW:
                        if part.column("__tw_copy")[i].as_py():
                            words = []
                        else:
                            edge = np.zeros(size + 1, np.int64)
                            starts = [own_repeats(hashes_of(raw))]
                            if (places := part.column("__tw_places")[i]).is_valid:
                                place, mask = (x.values.to_numpy(zero_copy_only=False) for x in (places, part.column("__tw_masks")[i]))
                                starts += [place[(mask >> j) & 1 == 1] - j for j in range(REST + 1)]
                            start = np.concatenate(starts)
                            if len(start):
                                np.add.at(edge, start, 1)
                                np.add.at(edge, start + WINDOW, -1)
                                words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                    texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                    sizes.append(size)
                    gone.append(size - len(words))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())], names=[*kept, *added])

    schema = docs.select(*kept).schema.add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    return joined.mapInArrow(run, schema)
