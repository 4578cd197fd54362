"""Cross-entropy difference of two matched n-gram models.

A target model (documents marked as good) and a background model (all documents) have the same
order, smoothing and vocabulary: the corpus' distinct words (ASCII capitals as small letters, since hashes are taken
of bytes) and one place for all words that it hasn't, so that a model's probabilities after a context sum to 1. Words and pairs
go by 64-bit hashes. Both are counted over every document; a document's score is the mean over its tokens of (target loss -
background loss), with the document's own counts taken out of both models, so that documents the
models have seen are not favoured. Lower is closer to the target.

Documents are cut into slices of bounded size. A slice asks for each distinct n-gram of its own once,
with its counts, by ranges of hashes; a range sums what all slices sent and answers each of them with
the totals. So nothing is gathered in one place, and a frequent n-gram is one entry a slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_trie import slices
from tracewell.llm.common import shared_dir, stage
from tracewell.llm.word_hash import word_hashes

#: Share of the pair model, of the word model and of the uniform one in a token's probability.
MIX = (0.6, 0.35, 0.05)
#: Bytes of text in a slice, and slices whose n-grams one range of hashes may hold.
SLICE, RANGE = 8 << 20, 4
#: Kinds of n-grams: word pairs, words as contexts, words.
KINDS = 3


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document's place, hashes of the pair, of the word before, of the word) of every token; a start mark stands before the first."""
    batch, docs, found, rows = pa.RecordBatch.from_arrays([texts], names=["text"]), [np.zeros(0, np.int64)], [np.zeros((2, 0), np.uint64)], 0
    for part in slices(batch, "text"):
        hashes, ends = word_hashes(part.column("text"), fold=True)
        sizes = np.diff(ends, prepend=0)
        docs.append(np.repeat(np.arange(len(sizes)), sizes) + rows)
        before = np.zeros_like(hashes)
        before[1:] = hashes[:-1]
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 1  # the start mark
        found.append(np.stack([before, hashes]))
        rows += part.num_rows
    before, hashes = np.concatenate(found, axis=1)
    mixed = before * np.uint64(0x9E3779B97F4A7C15) + hashes
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.concatenate(docs), mixed, before, hashes


_codec = pa.Codec("zstd", compression_level=1)


def pack(columns: list[np.ndarray]) -> bytes:
    """64-bit numbers as one compressed string, bytes of one weight together."""
    return _codec.compress(np.ascontiguousarray(np.concatenate(columns).view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def unpack(body: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(_codec.decompress(body, n * 8, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view(np.int64).ravel()


def sliced(docs: DataFrame, text: str) -> DataFrame:
    """Table (slice, body): documents by slices, each an Arrow stream; kept by slice, so that answers come to it."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, text, SLICE):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["slice", "body"])
                at += 1

    name = f"tracewell_slices_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.mapInArrow(run, "slice long, body binary").write.bucketBy(parts, "slice").sortBy("slice").option("path", f"{shared_dir(spark)}/tracewell/{name}").format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its entry: the files stay with the frame that reads them
    return table


def opened(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def ask(tables: DataFrame, text: str, ranges: int) -> DataFrame:
    """(range, slice, n, body): a slice's distinct n-grams of a range of hashes with its own counts for both models."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, body in zip(batch.column("slice").to_pylist(), batch.column("body"), strict=True):
                part = opened(body.as_buffer())
                doc, *hashes = grams(part.column(text))
                target = part.column("__tw_target").to_numpy(zero_copy_only=False).astype(np.float64)[doc]
                kinds = []
                for h in hashes:
                    keys, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
                    good = np.bincount(inverse, weights=target, minlength=len(keys)).astype(np.int64)
                    kinds.append((keys, n.astype(np.int64), good, np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])))
                rows = []
                for i in range(ranges):
                    cut = [slice(k[3][i], k[3][i + 1]) for k in kinds]
                    size = [c.stop - c.start for c in cut]
                    if any(size):
                        gaps = [np.diff(k[0][c], prepend=np.uint64(0)).view(np.int64) for k, c in zip(kinds, cut, strict=True)]
                        rows.append((i, at, size, pack([*gaps, *(k[1][c] for k, c in zip(kinds, cut, strict=True)), *(k[2][c] for k, c in zip(kinds, cut, strict=True))])))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()], strict=True)], names=["range", "slice", "n", "body"])

    return tables.mapInArrow(run, "range int, slice long, n array<long>, body binary")


def answer(asked: DataFrame, ranges: int) -> DataFrame:
    """(slice, range, n, body, background, target, vocabulary): the totals of the n-grams that a slice asked for, in its order.

    background, target: words of the range in each model, and vocabulary its distinct words, in one row of it and 0 in its others.
    """

    def total(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        numbers = [np.split(unpack(body, 3 * sum(n)), np.cumsum([*n, *n, *n])[:-1]) for _, _, n, body in rows]
        out: list[list[np.ndarray]] = [[] for _ in rows]
        sizes = [0, 0, 0]
        for k in range(KINDS):
            keys = np.concatenate([np.cumsum(x[k].view(np.uint64), dtype=np.uint64) for x in numbers])
            distinct, inverse = np.unique(keys, return_inverse=True)
            sizes[2] = len(distinct)
            cuts = np.cumsum([len(x[k]) for x in numbers])[:-1]
            for m in (0, 1):
                counts = np.concatenate([x[(m + 1) * KINDS + k] for x in numbers])
                sums = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
                sizes[m] = int(counts.sum())  # of each of the sizes the last kind's stays: words
                for o, x in zip(out, np.split(sums[inverse], cuts), strict=True):
                    o.append(x)
        for i, ((r, s, n, _), o) in enumerate(zip(rows, out, strict=True)):
            first = sizes if i == 0 else [0, 0, 0]
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([r], pa.int32()), pa.array([n], pa.list_(pa.int64())), pa.array([pack(o)], pa.binary()), *(pa.array([x], pa.int64()) for x in first)], names=["slice", "range", "n", "body", "background", "target", "vocabulary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("range", "slice", "n", "body")), strict=True):
                if rows and rows[0][0] != row[0]:
                    yield from total(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from total(rows)

    # Rows of a range follow one another, in any order of slices: sums don't depend on it.
    dealt = asked.repartition(ranges, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "slice long, range int, n array<long>, body binary, background long, target long, vocabulary long")


def _loss(pairs: np.ndarray, contexts: np.ndarray, singles: np.ndarray, total: np.ndarray, places: float) -> np.ndarray:
    """-log p of tokens by counts without the document's own; places: words of the vocabulary, with the one for unseen words."""
    a, b, c = MIX
    # What a model hasn't seen gives its share away: an unseen context to the words, a model without any words to the uniform one.
    words = singles / np.maximum(total, 1)
    p = np.where(contexts > 0, a * pairs / np.maximum(contexts, 1) + b * words, (a + b) * words) + c / places
    return -np.log(np.where(total > 0, p, 1 / places))


def _own(doc: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each token, how often its document has its n-gram."""
    _, inverse, n = np.unique(doc * (index.max(initial=0) + 1) + index, return_inverse=True, return_counts=True)
    return n[inverse].astype(np.float64)


def cross_entropy_difference(docs: DataFrame, is_target: Column, text: str = "text") -> DataFrame:
    """docs without text, with n_tokens (long), target_loss, background_loss and score (mean difference per token, double).

    is_target: which documents the target model is made of; null is no. Null, empty and blank
    texts have 0 tokens and null losses. Repeated rows count as often as they are there. If no
    other document is a target, the target model is uniform. Columns of these names are replaced.
    """
    added = ("n_tokens", "target_loss", "background_loss", "score")
    marked = docs.withColumn("__tw_target", F.coalesce(is_target, F.lit(False)))
    kept = [c for c in docs.columns if c != text and c not in added]
    schema = marked.select(*kept).schema.add("n_tokens", "long").add("target_loss", "double").add("background_loss", "double").add("score", "double")
    tables = sliced(marked.select(*kept, text, "__tw_target"), text)
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tables.count() // RANGE))
    answers = stage(answer(ask(tables, text, ranges), ranges), "answers")
    *sizes, places = (float(x or 0) for x in answers.agg(F.sum("background"), F.sum("target"), F.sum("vocabulary") + 1).first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, answered in zip(batch.column("body"), batch.column("answers"), strict=True):
                part = opened(body.as_buffer())
                doc, *hashes = grams(part.column(text))
                rows = part.num_rows
                n = np.bincount(doc, minlength=rows)
                # Ranges ascend as the slice's sorted n-grams do.
                bodies = sorted(answered.as_py() or [], key=lambda x: x["range"])
                numbers = [np.split(unpack(x["body"], 2 * sum(x["n"])), np.cumsum(np.repeat(x["n"], 2))[:-1]) for x in bodies]
                target = part.column("__tw_target").to_numpy(zero_copy_only=False).astype(np.float64)[doc]
                counts: list[list[np.ndarray]] = [[], []]
                for k, h in enumerate(hashes):
                    inverse = np.unique(h, return_inverse=True)[1]
                    own = _own(doc, inverse)
                    for m, share in ((0, 1.0), (1, target)):
                        sums = np.concatenate([x[2 * k + m] for x in numbers] or [np.zeros(0, np.int64)])
                        counts[m].append(sums[inverse] - own * share)
                losses = [_loss(*counts[0], sizes[0] - n[doc], places), _loss(*counts[1], sizes[1] - n[doc] * target, places)]
                empty = n == 0
                means = [np.bincount(doc, weights=x, minlength=rows) / np.maximum(n, 1) for x in losses]
                values = [means[1], means[0], means[1] - means[0]]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(n.astype(np.int64)), *(pa.array(v, mask=empty) for v in values)], names=[*kept, *added])

    by_slice = answers.groupBy("slice").agg(F.collect_list(F.struct("range", "n", "body")).alias("answers"))
    return tables.join(by_slice.hint("merge"), "slice", "left").select("body", "answers").mapInArrow(run, schema)
