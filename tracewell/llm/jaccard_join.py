"""Jaccard similarity join of documents' word n-grams by chosen paths.

Each document is the set of its runs of SHINGLE words. Documents with equal sets are one class;
the rest works on classes. Every set samples tokens (n-grams) at the rate RUNS / (t |x|), by one
hash of the token for all sets, so that similar sets likely sample the same ones: RUNS runs of the
chosen-path recursion at once. Sets that share a sampled token are a bucket; a bucket of over
LIMIT sets samples again, with hashes of the path so far, down to DEPTH tokens. Buckets are
searched by brute force, those that stay large in blocks of LIMIT sets and TOKENS tokens, so none is dropped.

A pair of similarity t shares 20 sampled tokens on average, and each survives two more levels with
probability 0.47 (1 - exp(-p) with p = 1 - exp(-1)), so it is missed with probability
exp(-9.4) = 0.0001 at most, and exp(-20) where the first level suffices.

Brute force has two steps, so that whole sets move little: sketches of SKETCH minima sort out pairs
far below t, then the sets of what is left are compared exactly. Of the buckets that two sets
share only the least one answers for the pair, so links are counted once without being listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_trie import slices
from tracewell.llm.common import discard, small_batches, stage
from tracewell.llm.components import connected
from tracewell.llm.word_hash import hashes_of, mix, word_hashes

#: Words in a token of a set; least similarity of a link, as a fraction.
SHINGLE = 5
THRESHOLD = (4, 5)
#: Runs, levels and the bucket size that is searched without sampling again.
RUNS, DEPTH, LIMIT = 20, 3, 1024
#: Tokens in the sets of one block, which bounds what a task holds by bytes as well (a longer set makes its own block).
TOKENS = 1 << 20
#: Rows and columns of a matrix that are made at once.
ROWS, COLUMNS = 256, 4096
#: One-byte minima in a sketch, and how many must agree: 51 do on average at the threshold, fewer than 35 in 1 of 10 million pairs.
SKETCH, AGREE = 64, 35

MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
PERMUTE = np.random.default_rng(64).integers(1, 1 << 31, (2, SKETCH), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
#: Place in the order of documents of a null id: after all others.
LAST = (1 << 63) - 1
KEY = ("path", "block_a", "block_b")


def shingles(hashes: np.ndarray) -> np.ndarray:
    """The sorted set of hashes of the runs of SHINGLE words of a text; a shorter text is one run; a text without words has none."""
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(hashes))):
        total += hashes[i : i + n] * MULTIPLIERS[i]
    return np.unique(mix(total))


def chosen(tokens: np.ndarray, path: int, rate: float) -> np.ndarray:
    """Paths that a set takes on from `path`: hashes of the path and each token it samples."""
    steps = mix(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) + np.uint64(path))
    share = rate * THRESHOLD[1] / (THRESHOLD[0] * max(len(tokens), 1))
    return steps if share >= 1 else steps[steps < np.uint64(int(share * 2.0**64))]


def sketch(tokens: np.ndarray) -> bytes:
    """One byte of the least token in each of SKETCH orders."""
    low = tokens.astype(np.uint32)
    least = np.full(SKETCH, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 4096):
        x = (low[at : at + 4096, None] ^ PERMUTE[1]) * PERMUTE[0]
        least = np.minimum(least, (x ^ (x >> np.uint32(15))).min(axis=0))
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in; name of the set (128 bits), size, chosen paths and sketch out."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            hashes, ends = word_hashes(part.column("text"))
            for a, b in zip([0, *ends], ends, strict=False):
                tokens = shingles(hashes[a:b])
                name = xxhash.xxh3_128_digest(tokens.tobytes())
                paths = np.unique(chosen(tokens, 0, RUNS)) if len(tokens) else tokens
                rows.append((int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True), len(tokens), paths.view(np.int64), sketch(tokens) if len(tokens) else b""))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text_key"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc", "text_key", "set_a", "set_b", "size", "paths", "sketch"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batch, "text"):
            packed = [pack((x or "").encode("utf-8", "surrogatepass")) for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text_key"), pa.array(packed, pa.binary())], names=["doc", "text_key", "packed"])


def _tokens(packed: pa.Scalar) -> np.ndarray:
    return shingles(hashes_of(zstandard.ZstdDecompressor().decompress(packed.as_py())))


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets with their paths into large buckets in; the paths they take on from there out."""
    for batch in batches:
        for i in range(batch.num_rows):
            tokens = _tokens(batch.column("packed")[i])
            for path, n in zip(*(batch.column(c)[i].as_py() for c in ("own", "sizes")), strict=True):
                new = np.unique(chosen(tokens, path % (1 << 64), 1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(new), pa.array(np.full(len(new), batch.column("node")[i].as_py())), pa.array(np.full(len(new), n)), pa.array(np.full(len(new), len(tokens)))], names=["path", "node", "above", "size"])


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows sorted by KEY as one group after the other; a group has two blocks at most. Rows of one node that repeat are left out."""
    key, held = None, {}
    for batch in batches:
        data = [batch.column(c).to_pylist() for c in (*KEY, *columns)]
        for values in zip(*data, strict=True):
            if values[:3] != key:
                if held:
                    yield key, held
                key, held = values[:3], {}
            held.setdefault(values[3], values[3:])
    if held:
        yield key, held


def _earlier(paths: list[list[int]], path: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, bucket) by bucket: which sets are in which buckets before this one that hold several of them."""
    owner = np.repeat(np.arange(len(paths)), list(map(len, paths)))
    names = np.fromiter(chain.from_iterable(paths), np.int64, len(owner))
    owner, names = owner[names < path], names[names < path]
    _, bucket, n = np.unique(names, return_inverse=True, return_counts=True)
    owner, bucket = owner[n[bucket] > 1], np.unique(bucket[n[bucket] > 1], return_inverse=True)[1]
    order = np.argsort(bucket, kind="stable")
    return owner[order], bucket[order]


def _met(before: tuple[np.ndarray, np.ndarray], rows: slice, n: int) -> np.ndarray:
    """Which pairs (rows, all n sets) share an earlier bucket; they are that bucket's pairs."""
    owner, bucket = before
    out = np.zeros((len(range(*rows.indices(n))), n), bool)
    for at in range(0, int(bucket.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(bucket, [at, at + COLUMNS])
        there = np.zeros((n, int(bucket[b - 1]) + 1 - at), np.float32)
        there[owner[a:b], bucket[a:b] - at] = 1
        out |= there[rows] @ there.T > 0
    return out


def _pairs(key: tuple, blocks: np.ndarray, rows: slice) -> np.ndarray:
    """Which pairs (rows, all) a group answers for: different sets of one block, or those across its two blocks."""
    if key[1] != key[2]:
        return blocks[rows, None] != blocks
    return np.arange(len(blocks))[rows, None] != np.arange(len(blocks))


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets with sketches in; (KEY, block, node) of sets with a pair that may be a link and that this bucket answers for out."""
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*KEY, "block", "node"])

    for key, held in _groups(batches, ("node", "block", "size", "sketch", "own")):
        if len(held) < 2:
            continue
        nodes, blocks, sizes, sketches, paths = (list(x) for x in zip(*held.values(), strict=True))
        size, blocks = np.array(sizes), np.array(blocks)
        codes = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), SKETCH)
        before = None
        for a in range(0, len(nodes), ROWS):
            rows = slice(a, a + ROWS)
            near = np.stack([(codes == row).sum(axis=1) for row in codes[rows]]) >= AGREE
            near &= THRESHOLD[1] * np.minimum(size[rows, None], size) >= THRESHOLD[0] * np.maximum(size[rows, None], size)
            near &= _pairs(key, blocks, rows)
            if near.any():
                before = _earlier(paths, key[0]) if before is None else before
                near &= ~_met(before, rows, len(nodes))
            out += [(*key, blocks[i], nodes[i]) for i in a + np.flatnonzero(near.any(axis=1))]
        if len(out) >= 20_000:
            yield made()
            out = []
    if out:
        yield made()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets with the buckets they are needed in: one row for each bucket, with the whole set, out."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("node", "copies", "own", "keys")}
            data = _tokens(batch.column("packed")[i]).tobytes()
            for at in range(0, len(row["keys"]), 64):
                keys = row["keys"][at : at + 64]
                n = len(keys)
                arrays = [*(pa.array([k[c] for k in keys], pa.int64()) for c in (*KEY, "block")), pa.array([row["node"]] * n, pa.int64()), pa.array([row["copies"]] * n, pa.int64()), pa.array([row["own"]] * n, pa.list_(pa.int64())), pa.array([data] * n, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*KEY, "block", "node", "copies", "own", "tokens"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    step = 2048
    for at in range(0, len(tokens), step):
        a, b = np.searchsorted(place, [at, at + step])
        there = np.zeros((len(sets), min(step, len(tokens) - at)), np.float32)
        there[owner[a:b], place[a:b] - at] = 1
        total += there @ there.T
    return total


def roots(links: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The least node of each node's component in a symmetric matrix of links."""
    label = nodes.copy()
    while True:
        new = label.copy()
        for a in range(0, len(label), ROWS):
            rows = slice(a, a + ROWS)
            new[rows] = np.minimum(label[rows], np.where(links[rows], label, LAST).min(axis=1))
        if (new == label).all():
            return label
        label = new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets with whole sets in; for each set with links its least partner's component, linked sets and linked documents out."""
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["node", "root", "texts", "docs"])

    for key, held in _groups(batches, ("node", "block", "copies", "own", "tokens")):
        if len(held) < 2:
            continue
        nodes, blocks, copies, paths, tokens = (list(x) for x in zip(*held.values(), strict=True))
        sets = [np.frombuffer(x, np.uint64) for x in tokens]
        link = overlaps(sets)
        size, blocks, before = np.array([len(s) for s in sets], np.float32), np.array(blocks), None
        found = np.zeros(link.shape, bool)
        for a in range(0, len(nodes), ROWS):
            rows = slice(a, a + ROWS)
            near = (THRESHOLD[1] * link[rows] >= THRESHOLD[0] * (size[rows, None] + size - link[rows])) & _pairs(key, blocks, rows)
            if near.any():
                before = _earlier(paths, key[0]) if before is None else before
                found[rows] = near & ~_met(before, rows, len(nodes))
        if found.any():
            label = roots(found, np.array(nodes))
            texts, docs = found.sum(axis=1), found @ np.array(copies)
            out += [(nodes[i], label[i], texts[i], docs[i]) for i in np.flatnonzero(texts)]
        if len(out) >= 20_000:
            yield made()
            out = []
    if out:
        yield made()


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id, copy_id, n_links, n_text_links) for each row of docs.

    class_id is the least doc_id that links lead to, at a Jaccard similarity of 4/5 or more; copy_id
    the least doc_id with the same set of n-grams; n_links the other documents (rows) linked to the
    row, copies included, and n_text_links the different sets linked to its own. Texts without words
    (null, empty, blank) link to nothing, and their class_id and copy_id are their own doc_id. Rows
    that share a doc_id are one node of the graph. A null doc_id takes part as the last document;
    ids that lead only to it are null.
    """
    small_batches(docs.sparkSession)
    wide = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    schema = "doc long, text_key long, set_a long, set_b long, size long, paths array<bigint>, sketch binary"
    known = stage(wide.mapInArrow(_describe, schema), "sets")
    named = known.where("size > 0")
    lead = F.min(F.struct("doc", "text_key", "size", "paths", "sketch")).alias("lead")
    classes = stage(named.groupBy("set_a", "set_b").agg(lead, F.count(F.lit(1)).alias("copies")).select("set_a", "set_b", F.col("lead.doc").alias("node"), "lead.text_key", "lead.size", "lead.paths", "lead.sketch", "copies"), "classes")
    packed = wide.mapInArrow(_pack, "doc long, text_key long, packed binary")

    def with_text(some: DataFrame) -> DataFrame:
        keyed = some.join(classes.select("node", "text_key", "copies"), "node")
        return packed.join(keyed.withColumnsRenamed({"node": "_node", "text_key": "_text_key"}), (F.col("doc") == F.col("_node")) & (F.col("text_key") == F.col("_text_key"))).withColumnRenamed("_node", "node")

    def counted(rows: DataFrame, name: str) -> DataFrame:
        """Rows (path, node, above, size) of buckets with company, and each bucket's sets n and tokens."""
        rows = stage(rows, f"{name}-rows")
        n = stage(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")).where("n > 1"), f"{name}-buckets")
        out = stage(rows.join(n, "path"), name)
        discard(rows, n)
        return out

    level = counted(classes.select(F.explode("paths").alias("path"), "node", F.lit((1 << 62)).alias("above"), "size"), "level1")
    buckets, levels = [], [level]
    for depth in range(1, DEPTH + 1):
        # A bucket that sampling again hardly made smaller holds sets that are all alike.
        final = (F.col("n") <= LIMIT) | (2 * F.col("n") >= F.col("above")) | F.lit(depth == DEPTH)
        buckets.append(level.where(final).select("path", "node", "n", "tokens"))
        large = level.where(~final)
        if depth == DEPTH or large.isEmpty():
            break
        own = large.groupBy("node").agg(F.collect_list(F.struct("path", "n")).alias("own"))
        grown = with_text(own).select("node", "packed", F.col("own.path").alias("own"), F.col("own.n").alias("sizes"))
        level = counted(grown.mapInArrow(_extend, "path long, node long, above long, size long").distinct(), f"level{depth + 1}")
        levels.append(level)
    members = buckets[0]
    for more in buckets[1:]:
        members = members.unionByName(more)
    members = stage(members, "members")
    discard(*levels)
    paths = stage(members.groupBy("node").agg(F.array_sort(F.collect_set("path")).alias("own")), "paths")
    blocks = F.greatest(F.ceil(F.col("n") / LIMIT), F.ceil(F.col("tokens") / TOKENS))
    at = F.pmod(F.xxhash64("node", "path"), blocks)
    dealt = members.withColumn("block", at).select("path", "node", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other"))
    dealt = dealt.select("path", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", "node")
    about = classes.select("node", "size", "sketch").join(paths, "node")
    sorted_ = lambda df: df.repartition(*KEY).sortWithinPartitions(*KEY)
    active = stage(sorted_(dealt.join(about, "node")).mapInArrow(_sift, "path long, block_a long, block_b long, block long, node long"), "active")
    discard(members)
    needed = active.groupBy("node").agg(F.collect_set(F.struct(*KEY, "block")).alias("keys")).join(paths, "node")
    whole = with_text(needed).mapInArrow(_sets, "path long, block_a long, block_b long, block long, node long, copies long, own array<bigint>, tokens binary")
    found = stage(sorted_(whole).mapInArrow(_compare, "node long, root long, texts long, docs long"), "found")
    discard(active, paths)
    links = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    groups = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    told = classes.select("set_a", "set_b", "node", "copies").join(links, "node", "left").join(groups, "node", "left")
    told = told.select("set_a", "set_b", "node", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    rows = known.select("doc", "set_a", "set_b", "size").join(told, ["set_a", "set_b"], "left")
    shown = lambda c: F.nullif(c, F.lit(LAST))
    alone = F.col("size") == 0
    own = lambda c, other: F.when(alone, other).otherwise(F.col(c))
    return rows.select(shown(F.col("doc")).alias("doc_id"), shown(own("root", F.col("doc"))).alias("class_id"), shown(own("node", F.col("doc"))).alias("copy_id"), own("n_links", F.lit(0)).cast("bigint").alias("n_links"), own("n_text_links", F.lit(0)).cast("bigint").alias("n_text_links"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id), one row for each doc_id that isn't null: the class of similar documents, as similar() has it; texts without words are a class each."""
    found = similar(docs, text, doc_id).where("doc_id IS NOT NULL AND class_id IS NOT NULL")
    return found.groupBy(F.col("doc_id").alias(doc_id)).agg(F.min("class_id").alias("class_id"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without the rows whose class has a smaller doc_id; all columns stay.

    A null doc_id counts as the largest. Rows that share the class's own doc_id stay together.
    Texts without words stay.
    """
    found = similar(docs, text, doc_id).select(F.col("doc_id").alias("__tw_doc"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("__tw_first")).groupBy("__tw_doc").agg(F.max("__tw_first").alias("__tw_first"))
    first = docs.join(found.where("__tw_first").select("__tw_doc"), F.col(doc_id).cast("bigint").eqNullSafe(F.col("__tw_doc")), "left_semi")
    return first
