"""Token-ID files coded by a static range asymmetric numeral system.

A file set is a folder of two Parquet tables, so that any store Spark can write takes it:

- `table`: (symbol, freq), the one frequency table that all blocks share; freq sums to 2**PRECISION;
- `blocks`: one row per block, in ascending doc_id order by (part, block). A block codes whole
  documents and stands alone: `lanes` coders take turns token by token, their states are kept
  every `stride` turns (`states`, and `offsets` into `payload` in 32-bit words), and `checks` has
  a CRC-32 of the payload between any two of these checkpoints. Segments between checkpoints are
  decoded side by side.

States are 64 bits wide in [2**31, 2**63) and exchange 32 bits at a time with the payload. Texts
are tokenized once, after a range shuffle by doc_id; the raw blocks are staged in the shared
folder, counted for the table (bounded by the vocabulary), coded, and read back.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.llm.bpe_trie import byte_symbols, slices
from tracewell.llm.chunks import NUMBERS, WHITE, Known, coded, joined, merged, spread
from tracewell.llm.common import stage
from tracewell.llm.recent import Recent

#: Frequencies sum to 2 to this power; it holds vocabularies of up to half a million ids.
PRECISION = 20
LOW = np.uint64(1 << 31)
#: Tokens after which a block ends with the current document.
BLOCK_TOKENS = 1 << 20
#: Most lanes of a block, and turns between checkpoints.
LANES, STRIDE = 2048, 128
#: Distinct words in each of the two generations that a worker remembers, and distinct chunks that it remembers.
REMEMBERED, CHUNKS = 300_000, 1_000_000
#: Bytes of text that are tokenized at once.
SLICE = 8 << 20
#: The pattern by which byte-level tokenizers split a text, for the Latin blocks.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_{NUMBERS}]+| ?[\d{NUMBERS}]+| ?(?:[^{WHITE}\w]|_)+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

RAW = "part long, block long, doc_ids array<bigint>, sizes array<int>, ids binary"
BLOCKS = "part long, block long, doc_ids array<bigint>, sizes array<int>, n_tokens long, lanes int, stride int, states binary, offsets array<int>, checks array<bigint>, payload binary"


class Tokens:
    """Ids of texts by the tokenizers library, which meets each distinct word once.

    The splitting pattern of byte-level tokenizers never joins a blank to what stands before it
    if something other than white space follows, so texts are cut before such blanks and the
    chunks' ids are put together. A new chunk is split by the pattern, and the library encodes
    its new words. Beyond the Latin blocks, where Unicode versions differ, the library splits too.
    Texts with a special token's string go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(1 + max(names.values()), np.int64)
        self.lengths[list(names.values())] = list(map(len, names))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known, self.met = Recent(REMEMBERED), Known(CHUNKS)
        self.cut = re.compile(f" (?=[^{WHITE}])")
        self.odd = f" [{WHITE}]| \\z"
        self.word = re.compile(PATTERN)
        self.beyond = re.compile("[^\x00-\u024f]")
        self.symbols = dict(enumerate(byte_symbols()))

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each)."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def learn(self, words: Iterable[str]) -> None:
        """Ids of new words, which the splitting pattern leaves whole; their bytes get their symbols all at once, but for words with line ends.

        The tokens of a word are those whose symbols make up its own, so all words' ids are cut at once.
        """
        lines = [w for w in words if "\n" in w]
        plain = [w for w in words if "\n" not in w] if lines else list(words)
        symbols = "\n".join(plain).encode().decode("latin-1").translate(self.symbols).split(self.symbols[10]) if plain else []
        symbols += [w.encode().decode("latin-1").translate(self.symbols) for w in lines]
        if not symbols:
            return
        cut = self.model.tokenize
        ids = np.array([x.id for symbol in symbols for x in cut(symbol)], "<i4")
        there, ends = np.cumsum(self.lengths[ids]), np.cumsum(np.fromiter(map(len, symbols), np.int64, len(symbols)))
        stops = np.minimum(np.searchsorted(there, ends), len(ids) - 1)
        if len(ids) and (there[stops] == ends).all():
            stops = (stops + 1) * 4
        else:  # a vocabulary without some byte's symbol
            stops = np.cumsum([4 * len(cut(symbol)) for symbol in symbols])
        raw = ids.tobytes()
        self.known.update(zip(chain(plain, lines), map(raw.__getitem__, map(slice, chain([0], stops.tolist()), stops.tolist())), strict=False))

    def near(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As chunks(), for those of the Latin blocks."""
        words = self.word.findall(" " + " ".join(chunks)) if chunks else []
        self.learn(self.known.unknown(words))
        # A chunk ends where a word does.
        ends = np.searchsorted(np.cumsum(list(map(len, words))), np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)) + 1
        return spread(list(map(self.known.__getitem__, words)), ends)

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct chunks, ids of each); each stands behind a blank."""
        if not self.beyond.search(" ".join(chunks)):
            return self.near(chunks)
        far = np.array([bool(self.beyond.search(x)) for x in chunks])
        near = [x for x, other in zip(chunks, far, strict=True) if not other]
        return merged(far, self.near(near), self.library([f" {x}" for x, other in zip(chunks, far, strict=True) if other]))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """32-bit ids of each text; a null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = np.zeros(len(texts), bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) & ~whole
        full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        plain = full & ~odd & ~whole
        out = [np.zeros(0, "<i4")] * len(texts)
        parts = [pc.split_pattern(texts.filter(pa.array(plain)), " ")]
        if odd.any():
            parts.append(pa.array([self.cut.split(x) for x in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string())))
        ids, ends = coded(*joined(parts), lambda words: self.met.coded(words, self.chunks), self.library)  # nothing stands before the first chunk
        for i, a, b in zip([*np.flatnonzero(plain), *np.flatnonzero(odd)], [0, *ends], ends, strict=False):
            out[i] = ids[a:b]
        for i in np.flatnonzero(whole):
            out[i] = self.library([texts[i].as_py()])[0]
        return out


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**PRECISION, each present symbol at least 1."""
    total = 1 << PRECISION
    counts = counts.astype(np.float64)
    present = counts > 0
    if present.sum() > total:
        raise ValueError("more symbols than the table can hold")
    freq = np.where(present, np.maximum(1, np.floor(counts / max(counts.sum(), 1) * total)), 0).astype(np.int64)
    # What rounding left over or took too much is evened out on the most frequent symbols.
    order = np.argsort(-counts, kind="stable")[: max(1, int(present.sum()))]
    short = total - int(freq.sum())
    at = 0
    while short and present.any():
        i = order[at % len(order)]
        step = short if short > 0 else max(short, -(int(freq[i]) // 2))
        if freq[i] + step >= 1:
            freq[i] += step
            short -= step
        at += 1
    return freq


def pack(ids: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Codes ids; (lanes, states at each checkpoint, offsets, checks, payload)."""
    n = len(ids)
    lanes = int(np.clip(n // 256, 1, LANES))
    turns = -(-n // lanes)
    padded = np.full(turns * lanes, ids[-1] if n else 0, np.int64)
    padded[:n] = ids
    rows = padded.reshape(turns, lanes)
    x = np.full(lanes, LOW, np.uint64)
    shift, word = np.uint64(63 - PRECISION), np.uint64(32)
    out: list[np.ndarray] = []
    states = []
    for t in range(turns - 1, -1, -1):
        f, c = freq[rows[t]], cum[rows[t]]
        over = x >= (f << shift)
        out.append(x[over].astype(np.uint32))
        x = np.where(over, x >> word, x)
        q = x // f
        x = (q << np.uint64(PRECISION)) + (x - q * f) + c
        if t % STRIDE == 0:
            states.append(x)
    out.reverse()
    sizes = np.cumsum([0, *map(len, out)])
    offsets = sizes[np.arange(0, turns, STRIDE)] if turns else np.zeros(0, np.int64)
    payload = np.concatenate(out) if out else np.zeros(0, np.uint32)
    ends = [*offsets[1:], len(payload)] if turns else []
    checks = [zlib.crc32(payload[a:b].tobytes()) for a, b in zip(offsets, ends, strict=True)]
    return lanes, np.array(states[::-1], np.uint64), offsets.astype(np.int32), checks, payload


def unpack(n: int, lanes: int, stride: int, states: np.ndarray, offsets: np.ndarray, checks: list[int], payload: np.ndarray, freq: np.ndarray, cum: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids of a block; all its segments are decoded side by side. A wrong checksum fails."""
    if not n:
        return np.zeros(0, np.int64)
    ends = [*offsets[1:], len(payload)]
    for i, (a, b) in enumerate(zip(offsets, ends, strict=True)):
        if zlib.crc32(payload[a:b].tobytes()) != checks[i]:
            raise ValueError(f"segment {i} of a block is damaged")
    turns = -(-n // lanes)
    segments = len(offsets)
    x = states.reshape(segments, lanes).copy()
    at = offsets.astype(np.int64)
    out = np.zeros((segments, stride, lanes), np.int32)
    mask, word, precision = np.uint64((1 << PRECISION) - 1), np.uint64(32), np.uint64(PRECISION)
    for t in range(min(stride, turns)):
        live = segments if (segments - 1) * stride + t < turns else segments - 1  # the last one may be shorter
        y = x[:live]
        slot = y & mask
        s = symbols[slot]
        out[:live, t] = s
        y = freq[s] * (y >> precision) + slot - cum[s]
        low = y < LOW
        took = low.sum(axis=1)
        places = np.cumsum(low, axis=1)
        places += (at[:live] - 1)[:, None]
        y[low] = (y[low] << word) | payload[places[low]].astype(np.uint64)
        at[:live] += took
        x[:live] = y
    return out.reshape(-1, lanes)[:turns].reshape(-1)[:n]


def _raw_blocks(docs: DataFrame, tokenizer: str, end_id: int, text: str, doc_id: str) -> DataFrame:
    """Rows RAW: documents in ascending doc_id order, in blocks of about BLOCK_TOKENS."""
    wide = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    keys = F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    ordered = wide.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, block = tokens(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<i4")
        doc_ids: list[int | None] = []
        rows: list[np.ndarray] = []
        size = 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "doc_ids": doc_ids, "sizes": [len(r) + 1 for r in rows[::2]], "ids": narrow(np.concatenate(rows))}], schema)

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for i, ids in zip(piece.column("doc_id").to_pylist(), known.encode(piece.column("text")), strict=True):
                    doc_ids.append(i)
                    rows += [ids, end]
                    size += len(ids) + 1
                    if size >= BLOCK_TOKENS:
                        yield made()
                        block, doc_ids, rows, size = block + 1, [], [], 0
        if rows:
            yield made()

    return ordered.mapInArrow(run, RAW)


def narrow(ids: np.ndarray) -> bytes:
    """32-bit ids as a marked array of 16-bit ones where all fit."""
    return b"2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"4" + ids.astype("<u4").tobytes()


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"2" else "<u4", offset=1).astype(np.int64)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> None:
    """Tokenizes whole texts (null: empty), appends end_id to each document and writes a file set to path.

    Documents stand in ascending doc_id order, null last; repeated ids are ordered by a hash of
    their texts. Other columns are not written. An empty table gives an empty file set.
    """
    raw = stage(_raw_blocks(docs, tokenizer, end_id, text, doc_id), "raw-blocks")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column(0):
                new = np.bincount(widen(row.as_py()))
                if len(new) > len(total):
                    new[: len(total)] += total
                    total = new
                else:
                    total[: len(new)] += new
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["symbol", "n"])

    # One row for each id of the vocabulary at most.
    counts = raw.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()
    symbols = counts.column("symbol").to_numpy()
    totals = np.zeros(symbols.max(initial=0) + 1, np.int64)
    totals[symbols] = counts.column("n").to_numpy()
    freq = frequencies(totals)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(freq)
    there = np.flatnonzero(freq)
    spark.createDataFrame([(int(s), int(freq[s])) for s in there], "symbol long, freq long").coalesce(1).write.parquet(f"{path}/table")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value.astype(np.uint64)
        cum = (np.cumsum(f) - f).astype(np.uint64)
        names = ["n_tokens", "lanes", "stride", "states", "offsets", "checks", "payload"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = widen(row.column("ids")[0].as_py())
                lanes, states, offsets, checks, payload = pack(ids, f, cum)
                values = [len(ids), lanes, STRIDE, states.tobytes(), offsets, checks, payload.tobytes()]
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("part", "block", "doc_ids", "sizes")), *(pa.array([v], k) for v, k in zip(values, kinds, strict=True))], names=["part", "block", "doc_ids", "sizes", *names])

    raw.mapInArrow(code, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def starts(index: DataFrame) -> DataFrame:
    """(part, block, block_start) from an index (part, block, n_tokens): ids of all blocks before, by sums within parts and over parts."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row for each range partition
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return index.select("part", "block", F.coalesce(inner, F.lit(0)).alias("_inner")).join(parts, "part").select("part", "block", (F.col("_before") + F.col("_inner")).alias("block_start"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: part, block, place (in the block), doc_id, offset (ids before it in its block), ids (little-endian 32-bit integers).

    Join with starts() of read_index() for its place in the whole set. Damaged payloads fail.
    """
    table = spark.read.parquet(f"{path}/table").toArrow()  # bounded by the vocabulary
    symbols = table.column("symbol").to_numpy()
    freq = np.zeros(symbols.max(initial=0) + 1, np.uint64)
    freq[symbols] = table.column("freq").to_numpy().astype(np.uint64)
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        cum = (np.cumsum(f) - f).astype(np.uint64)
        symbols = np.repeat(np.arange(len(f), dtype=np.int32), f.astype(np.int64))
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                n, lanes, stride = (row[c].as_py() for c in ("n_tokens", "lanes", "stride"))
                offsets = row["offsets"].values.to_numpy()
                states, payload = (np.frombuffer(row[c].as_buffer(), k) for c, k in (("states", np.uint64), ("payload", np.uint32)))
                ids = unpack(n, lanes, stride, states, offsets, row["checks"].as_py(), payload, f, cum, symbols)
                sizes = row["sizes"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                data = pa.py_buffer(ids.astype("<u4").tobytes())
                bounds = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32).tobytes())
                rows = len(sizes)
                texts = pa.Array.from_buffers(pa.binary(), rows, [None, bounds, data])
                same = lambda c: pa.array(np.full(rows, row[c].as_py(), np.int64))  # noqa: B023, E731
                whole = pa.RecordBatch.from_arrays([same("part"), same("block"), pa.array(np.arange(rows)), row["doc_ids"].values, pa.array(ends - sizes), texts], names=["part", "block", "place", "doc_id", "offset", "ids"])
                for at in range(0, rows, 500):
                    yield whole.slice(at, 500)

    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, "part long, block long, place long, doc_id long, offset long, ids binary")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/blocks").select("part", "block", "n_tokens")

