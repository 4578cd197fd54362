"""Encoding of texts by their distinct chunks: Arrow cuts texts and numbers the chunks, so that Python meets each distinct one of a slice once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"

#: Numbers of the Latin blocks that aren't digits.
NUMBERS = "\xb2\xb3\xb9\xbc\xbd\xbe"


def joined(parts: list[pa.ListArray]) -> tuple[pa.Array, np.ndarray]:
    """(chunks of all lists one after the other, the place after each list's last chunk). The lists aren't null."""
    flat = [p.flatten() for p in parts]
    sizes = np.concatenate([np.diff(p.offsets.to_numpy()) for p in parts])
    return (flat[0] if len(flat) == 1 else pa.concat_arrays(flat)), np.cumsum(sizes)


def spread(words: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit ids of all words, ids of each group of words); ends: the place after each group's last word."""
    stops = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) >> 2)])
    return np.frombuffer(b"".join(words), "<i4"), np.diff(stops[ends], prepend=0)


def merged(far: np.ndarray, near_ids: tuple[np.ndarray, np.ndarray], far_ids: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of chunks of which some, those marked far, were coded apart."""
    order = np.argsort(far, kind="stable")
    sizes = np.concatenate([near_ids[1], far_ids[1]])
    own = np.empty_like(sizes)
    own[order] = sizes
    to = np.repeat((np.cumsum(own) - own)[order] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    ids = np.empty(len(to), np.int32)
    ids[to] = np.concatenate([near_ids[0], far_ids[0]])
    return ids, own


class Known:
    """Ids of the chunks that a worker met lately, in Arrow arrays: chunks of two slices and more cost no Python. At most `limit` chunks, and those of one slice."""

    def __init__(self, limit: int):
        self.limit = limit
        self.chunks, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def coded(self, chunks: pa.Array, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct chunks, ids of each); encode: the same for those that are new."""
        at = pc.fill_null(pc.index_in(chunks, value_set=self.chunks), -1).to_numpy()
        fresh = at < 0
        new = chunks.filter(pa.array(fresh))
        ids, sizes = encode(new.to_numpy(zero_copy_only=False).tolist())
        met = at[~fresh]
        all_ids, all_sizes = merged(fresh, self.taken(met), (ids, sizes))
        if len(self.chunks) + len(new) > self.limit:
            self.chunks, self.ids, self.sizes = chunks, all_ids, all_sizes
        else:
            self.chunks, self.ids, self.sizes = pa.concat_arrays([self.chunks, new]), np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return all_ids, all_sizes

    def taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the chunks at some places."""
        sizes = self.sizes[at]
        shift = (np.cumsum(self.sizes) - self.sizes)[at] - np.cumsum(sizes) + sizes
        return self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def coded(chunks: pa.Array, ends: np.ndarray, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], first: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all lists of chunks, the place after each list's last id).

    encode: (ids, sizes) of distinct chunks; first: the same for the chunks that begin a list, if they are coded
    apart, which encode() then doesn't get: they may begin with white space, that would run into another chunk's.
    """
    numbers = chunks.dictionary_encode()
    index, words = numbers.indices.to_numpy(zero_copy_only=False), numbers.dictionary
    if first is None:
        ids, sizes = encode(words)
    else:
        starts = np.concatenate([[0], ends[:-1]])
        starts = starts[starts < ends]
        inner = np.ones(len(index), bool)
        inner[starts] = False
        used = np.zeros(len(words), bool)
        used[index[inner]] = True
        ids, some = encode(words.filter(pa.array(used)))
        sizes = np.zeros(len(words) + len(starts), np.int64)
        sizes[: len(words)][used] = some
        index = index.copy()
        index[starts] = np.arange(len(words), len(sizes))
        more, sizes[len(words) :] = first(chunks.take(pa.array(starts)).to_pylist())
        ids = np.concatenate([ids, more])
    n = sizes[index]
    stops = np.concatenate([[0], np.cumsum(n)])
    shift = (np.cumsum(sizes) - sizes)[index] - stops[:-1]
    place = np.repeat(shift.astype(np.int32), n)
    place += np.arange(len(place), dtype=np.int32)
    return ids[place], stops[ends]
