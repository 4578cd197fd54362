"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

A BPE encoding can be grown symbol by symbol: the last token of a prefix is the one token
that ends it and that can stand, unmerged, behind the last token of what is before it. So
each task puts the distinct words of its rows into a trie and walks it depth first, keeping
the last token of every prefix on the path; words that share a prefix share its encoding.
No shuffle: tables of the tokenizer are read by each Python worker from its own path.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracewell.llm.chunks import NUMBERS, WHITE, coded, joined, merged, spread
from tracewell.llm.common import small_batches
from tracewell.llm.recent import Recent

#: Text is worked on in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 2 << 20
#: ... and encoded in slices of so many.
ENCODED = 4 << 20
#: Distinct words in each of the two generations that a worker remembers.
REMEMBERED = 100_000
NEVER = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Vocabulary and merges of a tokenizer file, with the walks that the trie needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        names = [""] * size
        for name, i in [*self.ids.items(), *self.special.items()]:
            names[i] = name
        self.symbol = byte_symbols()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # of a merged token: left, right, rank
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.ids[a], self.ids[b]
            self.rank.setdefault(pair, rank)
            self.parts.setdefault(self.ids[a + b], (*pair, rank))
        for left, right, rank in self.parts.values():
            if max(self.parts[x][2] if x in self.parts else -1 for x in (left, right)) >= rank:
                raise ValueError("a merge stands before the merges of its parts")
        # Symbols in a token; the end-of-word mark is part of the last one.
        mark = len(self.end)
        self.sizes = [len(x) - (mark if mark and x.endswith(self.end) else 0) for x in names]
        # The most symbols in a token, by its last three symbols.
        self.reach: dict[str, int] = {}
        for name, token in self.ids.items():
            if (size := self.sizes[token]) > 2:
                tail = name[size - 3 :]
                self.reach[tail] = max(size, self.reach.get(tail, 0))
        self.fits = Recent(100_000)
        self.whole: dict[int, bool] = {}
        self.edges = Recent(20_000)

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at the token's left (0) or right (1) end as it is merged, each with the rank that uses it up."""
        if self.edges.unknown([(token, side)]):
            found, inner = [(token, NEVER)], token
            while inner in self.parts:
                rank, inner = self.parts[inner][2], self.parts[inner][side]
                found.append((inner, rank))
            self.edges[token, side] = found[::-1]
        return self.edges[token, side]

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether nothing merges across the border of two tokens before the merge `until`."""
        left, right = self.edge(a, 1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, x_used), (y, y_used) = left[i], right[j]
            rank = self.rank.get((x, y), NEVER)
            if rank < until and rank < x_used and rank <= y_used:  # of equal merges the leftmost goes first
                return False
            if x_used == NEVER and y_used == NEVER:
                return True
            if x_used <= y_used:
                i += 1
            else:
                j += 1

    def is_whole(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token."""
        if token not in self.parts:
            return True
        if (known := self.whole.get(token)) is None:
            left, right, rank = self.parts[token]
            known = self.whole[token] = self.is_whole(left) and self.is_whole(right) and self.apart(left, right, rank)
        return known

    def last_token(self, text: str, i: int, stop: int, lasts: list[int]) -> int:
        """The last token of the encoding of the prefix of text that ends with symbol i, at stop; lasts: those of all shorter prefixes."""
        ids, fits = self.ids.get, self.fits
        most = self.reach.get(text[i - 2 : stop], 2) if i > 1 else i + 1
        for start in range(max(0, i - most + 1), i + 1):
            token = ids(text[start:stop])
            if token is None:
                continue
            if not start:
                if self.is_whole(token):
                    return token
                continue
            key = lasts[start - 1], token
            try:
                fit = fits[key]
            except KeyError:
                fits.unknown(())
                fit = fits[key] = self.is_whole(token) and self.apart(*key)
            if fit:
                return token
        raise ValueError(f"no encoding for {text[:stop]!r}")

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of each distinct word.

        Sorted, the words are the leaves of their trie in depth-first order; the stack holds
        the path from the root and the last token of each prefix on it.
        """
        end, last_token, sizes = self.end, self.last_token, self.sizes
        translate = {b: c for b, c in enumerate(self.symbol)}
        before: str = ""
        lasts: list[int] = []  # the path from the root: the last token of each prefix
        out = {}
        for symbols, word in sorted((w.encode().decode("latin-1").translate(translate), w) for w in words):
            if not symbols:
                out[word] = []
                continue
            # The last symbol of a word is another one than in the middle of a word, so it is never shared.
            n = len(symbols)
            shared, most = 0, min(len(before), n) - 1
            while shared < most and before[shared] == symbols[shared]:
                shared += 1
            del lasts[shared:]
            for i in range(shared, n - 1):
                lasts.append(last_token(symbols, i, i + 1, lasts))
            lasts.append(last_token(symbols + end, n - 1, n + len(end), lasts))
            ids, at = [], n
            while at:
                token = lasts[at - 1]
                ids.append(token)
                at -= sizes[token]
            out[word] = ids[::-1]
            before = symbols
        return out


class Encoder:
    """Splits texts into words as the tokenizer file says and looks their encodings up, distinct words once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.path = path
        self.known = Recent(REMEMBERED)
        self.special = self.vocabulary.special
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.word = re.compile(rf" |'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_{NUMBERS}]+|[\d{NUMBERS}]|(?:[^{WHITE}\w]|_)+")
        self.space = re.compile(f"[{WHITE}]+")
        self.beyond = re.compile("[^\x00-\u024f]")
        self.library = None

    def split(self, text: str) -> list[str]:
        """Chunks of a text, special tokens' strings as chunks of their own."""
        return [x for part in self.marks.split(text) for x in ([part] if part in self.special else self.space.split(part)) if x]

    def foreign(self, chunk: str) -> list[str]:
        """Words of a chunk by the tokenizers library."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.back = {c: b for b, c in enumerate(self.vocabulary.symbol)}
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(map(self.back.__getitem__, x)).decode() for x, _ in found]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words; new ones are encoded by the trie of all that are new."""
        for word, ids in self.vocabulary.encode_words(self.known.unknown(words)).items():
            self.known[word] = struct.pack(f"<{len(ids)}i", *ids)
        return list(map(self.known.__getitem__, words))

    def near(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As chunks(), for those of the Latin blocks, in which nothing is composed and Python's tables agree with the library's."""
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        words = self.word.findall(" ".join(chunks).lower())
        self.known[" "] = b""
        ends = np.flatnonzero(np.fromiter((x == " " for x in words), bool, len(words)))
        return spread(self.words(words), np.append(ends, len(words)))

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct chunks, ids of each): composed, lower-cased, split; none of that looks across white space.

        Beyond the Latin blocks, where Unicode versions differ, the tokenizers library
        composes, lower-cases and splits.
        """
        if not self.beyond.search(" ".join(chunks)) and self.special.keys().isdisjoint(chunks):
            return self.near(chunks)
        far = np.array([bool(self.beyond.search(x)) or x in self.special for x in chunks])
        rows = [struct.pack("<i", self.special[x]) if x in self.special else b"".join(self.words(self.foreign(x))) for x, other in zip(chunks, far, strict=True) if other]
        return merged(far, self.near([x for x, other in zip(chunks, far, strict=True) if not other]), spread(rows, np.arange(1, len(rows) + 1)))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Lists of ids of the texts; a null has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # White space for Arrow's splitting only, and texts that may have a special token.
        odd = pc.or_(pc.match_substring_regex(texts, "[\x1c-\x1f]"), pc.match_substring(texts, "<|")).to_numpy(zero_copy_only=False)
        parts = [pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts.filter(pa.array(~odd))))]
        if odd.any():
            parts.append(pa.array([self.split(x) for x in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string())))
        ids, ends = coded(*joined(parts), lambda words: self.chunks(words.to_numpy(zero_copy_only=False).tolist()))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
        return lists.take(pa.array(np.argsort(np.argsort(odd, kind="stable"), kind="stable"))) if odd.any() else lists


_encoders: dict[str, Encoder] = {}
_names: dict[str, pa.Array] = {}


def forget(path: str) -> None:
    """Frees a worker's encoder at the end of a task: Spark keeps idle workers, and other stages need their memory."""
    _encoders.pop(path, None)
    pa.default_memory_pool().release_unused()


def encoder(path: str) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_names(path: str) -> pa.Array:
    """The token of each id of a tokenizer file."""
    if path not in _names:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = [""] * (1 + max(ids.values()))
        for name, i in ids.items():
            names[i] = name
        _names[path] = pa.array(names, pa.string())
    return _names[path]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about `limit` bytes of text; a longer text makes its own slice."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    ends = np.flatnonzero(np.diff(size // limit)) + 1
    for a, b in zip([0, *ends], [*ends, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _with(df: DataFrame, name: str, kind: T.DataType, make, end=lambda: None) -> DataFrame:
    """df with one more column, which make() computes from a batch; a column of that name is replaced. A task calls end() at last."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, column in make(batch):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), column], names=[*kept, name])
        end()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """docs with the ids of each whole text, as the tokenizers library gives them without template tokens.

    tokenizer: path of a tokenizer file of the lower-casing word kind, readable by every worker.
    Null and empty texts get an empty list; special tokens' strings in a text become their ids;
    repeated rows are encoded each; a column named `out` is replaced, all others stay.
    """

    def make(batch):
        known = encoder(tokenizer)
        for part in slices(batch, text, ENCODED):
            yield part, known.encode(part.column(text))

    return _with(docs, out, T.ArrayType(T.IntegerType()), make, lambda: forget(tokenizer))


def decode(encoded: DataFrame, tokenizer: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """encoded with the text of each list of ids: the tokens, joined by blanks, special ones included.

    Null and empty lists give an empty text; ids outside the vocabulary fail.
    """

    def make(batch):
        names = token_names(tokenizer)
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lists = part.column(ids)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), names.take(lists.flatten()))
            yield part, pc.binary_join(tokens, " ")

    return _with(encoded, out, T.StringType(), make)
