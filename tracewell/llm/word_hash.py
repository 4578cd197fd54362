"""64-bit hashes of the words of texts, computed for all bytes of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_random = np.random.default_rng(64)
#: A random number for each byte; white space has none.
BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The same with ASCII capitals as their small letters.
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]
INK = np.ones(256, bool)
INK[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words of letters and digits: of ASCII only these, and all of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Base of the polynomial, 3 modulo 8, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C13
INVERSE = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; kept for next time unless a very long text asks for them."""
    if n <= len(_powers[0]):
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (BASE, INVERSE):
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 1 << 23:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: pa.Array, fold: bool = False, letters: np.ndarray = INK) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words [^\\x20\\x09-\\x0D]+ of all texts, one after the other; the place after each text's last word).

    Nulls have no words. fold: ASCII capitals count as small letters. letters: the bytes of words, if others than these.
    """
    if texts.null_count:
        texts = pc.fill_null(texts, pa.scalar("" if not pa.types.is_binary(texts.type) else b"", texts.type))
    _, bounds, data = texts.buffers()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or bounds[0] == bounds[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    ink = letters[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], ink[:-1]]) & ~edge[:-1]
    after = np.concatenate([ink[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    power, inverse = powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((FOLDED if fold else BYTES)[raw] * power, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts])
    return np.maximum(hashes, np.uint64(1)), np.searchsorted(starts, bounds[1:])


def hashes_of(text: bytes) -> np.ndarray:
    """Hashes of the words of one text."""
    return word_hashes(pa.array([text], pa.binary()))[0]
