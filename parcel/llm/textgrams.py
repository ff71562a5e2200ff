"""Word and word-run hashes of many texts at a time, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(1 << 16, _FACTOR, np.uint64))
_FAR_POWERS = np.cumprod(np.full(1 << 16, _POWERS[-1], np.uint64))  # of the upper half of a place
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes between words: ASCII whitespace, or all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[128:] = False
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False
#: Bytes hashed at a time; each takes some 40 bytes of memory meanwhile.
CHUNK = 1 << 19


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer; another salt gives another hash."""
    x = x ^ np.uint64((salt * 0xD1B54A32D192ED03) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _chunk_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of low[start:end] for words that lie in this order."""
    place = np.arange(len(low), dtype=np.int64)
    # a byte's place in its word; what lies between words is cut off below
    place -= np.repeat(starts, np.diff(np.append(starts, len(low))))
    value = _BYTES[low] * _POWERS[place & 0xFFFF]
    if place[-1] >> 16:
        far = place >> 16
        value = np.where(far > 0, value * _FAR_POWERS[np.minimum(far, 0xFFFF) - 1], value)
    inside = np.empty(2 * len(starts), np.int64)
    inside[0::2], inside[1::2] = starts, np.minimum(ends, len(low) - 1)
    sums = np.add.reduceat(value, inside)[0::2]
    if ends[-1] == len(low):  # reduceat can't name the end of the array
        sums[-1] = value[starts[-1] :].sum(dtype=np.uint64)
    return mixed(sums ^ (ends - starts).astype(np.uint64))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins and the
    last ends."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without the bytes ``between``, A-Z lower-cased)
    of all texts in a row, and where each text's words begin and the last end. A
    null text has none."""
    data, offsets = bytes_of(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = between[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = ~space[inner]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    found, i = [], 0
    while i < len(starts):  # in pieces that end with a word
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + CHUNK, "right")))
        low = _LOWER[data[starts[i] : stops[j - 1]]]
        found.append(_chunk_words(low, starts[i:j] - starts[i], stops[i:j] - starts[i]))
        i = j
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), np.searchsorted(starts, offsets)


def word_runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of so many words; of all words, if there are fewer."""
    n = min(length, len(words))
    if not n:
        return np.empty(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = total * _FACTOR + words[i : len(words) - n + 1 + i]
    return mixed(total)
