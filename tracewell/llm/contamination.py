"""Benchmark decontamination by winnowing.

An item's windows are its runs of WINDOW words; an item of fewer words is one window. Each window
elects, of the GRAM-word runs in it, the one of least hash (the leftmost, of equals): its
fingerprint. Equal windows elect the same run, so a span of WINDOW words that a document shares with an
item always shares a fingerprint. A window of fewer words is its own fingerprint.

1. The items' fingerprints make a filter of a fixed number of bits at most, which goes to all tasks.
2. Documents are read once. Windows whose fingerprint may be an item's are kept, with the hash of
   the whole window; the same ones of a document are one row.
3. These are joined with the items' distinct windows on the fingerprint and its extension to the
   window, so that a fingerprint that many documents and items share makes no pairs of them.
4. Windows that the same items have are one class. Documents meet classes, and only then the
   class's items, once each.

Words, fingerprints and windows are compared by 64-bit hashes; a match needs two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.bpe_trie import slices
from tracewell.llm.common import stage
from tracewell.llm.substring_dedup import MULTIPLIERS, rolled
from tracewell.llm.word_hash import ALNUM, mix, word_hashes

#: Words in a window, and in the runs that windows elect from.
WINDOW, GRAM = 10, 6
#: Bits of the filter: so many for each fingerprint, and at least and at most so many in all (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
#: Bytes of text that a task works on at once.
SLICE = 4 << 20

_WINDOWS = T.ArrayType(T.StructType().add("fingerprint", "long").add("name", "long").add("size", "integer").add("starts", T.ArrayType(T.IntegerType())))


def elected(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all windows of texts whose words stand one after the other, the fingerprint of each)."""
    grams = rolled(hashes, GRAM)
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(hashes))
    start = np.flatnonzero(room >= WINDOW)
    least = grams[start]
    for j in range(1, WINDOW - GRAM + 1):
        np.minimum(least, grams[start + j], out=least)
    return start, least


def short(hashes: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for windows of fewer words, which are their own fingerprints."""
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(hashes))
    start = np.flatnonzero(room >= size)
    return start, mix(rolled(hashes, size)[start] + np.uint64(size))


def names(hashes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of whole windows, independent of the fingerprints'."""
    total = np.zeros(len(start), np.uint64)
    for i in range(size):
        total += hashes[start + i] * MULTIPLIERS[1, i]
    return mix(total)


def _item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (fingerprint, name, size, item) of all items; size is null in a row for each window's size that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, ends = word_hashes(part.column("text"), fold=True, letters=ALNUM)
                sizes = np.diff(ends, prepend=0)
                found = [(*elected(hashes, ends), WINDOW)]
                for size in np.unique(sizes[(sizes > 0) & (sizes < WINDOW)]):
                    start, prints = short(hashes, ends, size)
                    whole = np.isin(start, (ends - sizes)[sizes == size])
                    found.append((start[whole], prints[whole], size))
                for start, prints, size in found:
                    item = part.column("item").take(pa.array(np.searchsorted(ends, start, "right")))
                    arrays = [pa.array(prints.view(np.int64)), pa.array(names(hashes, start, size).view(np.int64)), pa.array(np.full(len(start), size, np.int32)), item]
                    yield pa.RecordBatch.from_arrays(arrays, names=["fingerprint", "name", "size", "item"])

    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "fingerprint long, name long, size int, item string").distinct()


def _filter(prints: DataFrame) -> np.ndarray:
    """Bits of fingerprints as 64-bit words, a power of two of them, MOST_BITS / 64 at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS_EACH * prints.count() - 1).bit_length()))
    place = F.col("fingerprint").bitwiseAND(bits - 1)
    word = prints.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(fingerprint & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[word.column("word").to_numpy()] = word.column("bits").to_numpy()
    return out.view(np.uint64)


def may_be(prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter has each fingerprint."""
    at = prints & np.uint64(64 * len(bits) - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _listed(doc: np.ndarray, prints: np.ndarray, name: np.ndarray, size: np.ndarray, start: np.ndarray, n: int) -> pa.Array:
    """Windows of n documents as _WINDOWS: of equal windows of a document one entry with all its starts."""
    order = np.lexsort((start, name, prints, size, doc))
    doc, prints, name, size, start = (x[order] for x in (doc, prints, name, size, start))
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (size[1:] != size[:-1]) | (prints[1:] != prints[:-1]) | (name[1:] != name[:-1])
    first = np.flatnonzero(fresh)
    starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(start.astype(np.int32)))
    fields = [pa.array(prints[first].view(np.int64)), pa.array(name[first].view(np.int64)), pa.array(size[first].astype(np.int32)), starts]
    entries = pa.StructArray.from_arrays(fields, ["fingerprint", "name", "size", "starts"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)), entries)


def _candidates(docs: DataFrame, text: str, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """docs with n_words and the windows whose fingerprint may be an item's (__tw_windows) instead of the text."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept).schema.add("n_words", "long").add("__tw_windows", _WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                hashes, ends = word_hashes(part.column(text), fold=True, letters=ALNUM)
                found = []
                for size in sizes:
                    start, prints = elected(hashes, ends) if size == WINDOW else short(hashes, ends, size)
                    fits = may_be(prints, bits)
                    start, prints = start[fits], prints[fits]
                    found.append((np.searchsorted(ends, start, "right"), prints, names(hashes, start, size), np.full(len(start), size), start))
                n = np.diff(ends, prepend=0)
                doc, prints, name, size, start = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
                windows = _listed(doc, prints.view(np.uint64), name.view(np.uint64), size, start - (ends - n)[doc], len(n))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(n.astype(np.int64)), windows], names=[*kept, "n_words", "__tw_windows"])

    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with n_words and n_hit (long), windows (sorted array of (start, size) in words) and items (sorted array of ids as strings) instead of text.

    Words are runs of ASCII letters and digits and all other non-ASCII characters, ASCII capitals as small letters. A
    document's word is hit if an occurrence of an item's window covers it; items lists those with a window in the document. Null and
    empty texts have no words; items without words have no window; a null item id is listed as '', and rows of one id are one item.
    Every row of docs stays, repeated ones each, with all other columns; those of the new names are replaced.
    """
    added = ("n_words", "n_hit", "windows", "items")
    windows = stage(_item_windows(items, item_id, item_text), "item-windows")
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # WINDOW at most
    bits = _filter(windows.select("fingerprint").distinct())
    own = docs.drop(*added).withColumn("__tw_row", F.monotonically_increasing_id())
    rows = stage(_candidates(own, text, bits, sizes), "candidates")
    # Windows of the same items have one class, named by two hashes and the number of items.
    hashed = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "item"))
    classes = windows.groupBy("fingerprint", "name", "size").agg(F.struct(hashed(1).alias("a"), hashed(2).alias("b"), F.count(F.lit(1)).alias("n")).alias("class"))
    classes = stage(classes, "classes")
    found = rows.select("__tw_row", F.explode("__tw_windows").alias("w")).select("__tw_row", "w.*")
    hits = stage(found.join(classes, ["fingerprint", "name", "size"]).select("__tw_row", "size", "starts", "class"), "hits")
    lead = classes.groupBy("class").agg(F.min(F.struct("fingerprint", "name", "size")).alias("w")).select("class", "w.*")
    members = windows.join(lead, ["fingerprint", "name", "size"]).select("class", "item")
    listed = hits.select("__tw_row", "class").distinct().join(members, "class").groupBy("__tw_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    spans = F.transform("starts", lambda x: F.struct(x.alias("start"), F.col("size").alias("size")))
    placed = hits.groupBy("__tw_row").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("windows"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("windows", start, lambda s, w: F.struct(F.greatest(s.end, w.start + w.size).alias("end"), (s.n + F.greatest(F.lit(0), w.start + w.size - F.greatest(s.end, w.start))).alias("n")), lambda s: s.n)
    joined = rows.drop("__tw_windows").join(placed, "__tw_row", "left").join(listed, "__tw_row", "left")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    kept = [c for c in docs.columns if c != text and c not in added]
    return joined.select(*kept, "n_words", F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_hit"), empty(F.col("windows"), "array<struct<start: int, size: int>>").alias("windows"), empty(F.col("items"), "array<string>").alias("items"))
