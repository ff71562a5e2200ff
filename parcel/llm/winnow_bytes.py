"""Anchors of byte texts in numpy: a place in every window of ``LENGTH`` bytes.

Of the ``GRAM``-byte strings in a window the one with the smallest hash is its
anchor (the first of equal ones). Which place that is depends on the window's
bytes alone, so equal windows have their anchor at the same place. Windows that
start next to each other mostly share their anchor; such a run is written
(anchor, first start, last start).
"""

from __future__ import annotations

import numpy as np

from parcel.llm.textgrams import mixed

LENGTH, GRAM = 200, 32
#: Bytes taken at a time.
CHUNK = 2 << 20
_SPAN = LENGTH - GRAM + 1  # grams in a window
_PLACE_BITS = 22
_RNG = np.random.default_rng(20240301)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_MOST = CHUNK + LENGTH


def _powers(factor: int) -> np.ndarray:
    out = np.full(_MOST + 1, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out)  # modulo 2 ** 64


_UP, _DOWN = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the string of this length at each place where there is one; at
    most CHUNK + LENGTH bytes."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[data] * _UP[: len(data)], out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * _DOWN[: len(data) - length + 1])


def _least_place(keys: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each ``span`` neighbours."""
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = span - width
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def runs_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie in a row and end at ``ends``: the hash of each run's
    anchor gram, its place, and the first and last window start."""
    found, at = [], 0
    while at + LENGTH <= len(data):
        part = data[at : at + CHUNK + LENGTH - 1]
        grams = string_hashes(part, GRAM)
        place = np.arange(len(grams), dtype=np.uint64)
        keys = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
        anchor = (_least_place(keys, _SPAN) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        starts = np.arange(len(anchor))
        # a window that goes beyond its text's end is none
        text_end = ends[np.searchsorted(ends, at + starts, "right")]
        anchor[at + starts + LENGTH > text_end] = -1
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        last = np.append(first[1:], len(anchor)) - 1
        real = anchor[first] >= 0
        first, last = first[real], last[real]
        held = anchor[first]
        found.append((grams[held], at + held, at + first, at + last))
        at += len(anchor)
    if not found:
        return tuple(np.empty(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))
