"""64-bit hashes of words and of word shingles, for whole batches of texts at a time.

Words are runs of bytes other than space and the controls 9 to 13; A-Z count as a-z. A shingle is
told apart by its hash: two different ones of a pair of documents are taken for one with a
probability of about 2 ** -64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from signalmill.llm.common import separated

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)[_LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(0, 2**64, 16, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and bytes of each word of all texts, and offsets of the texts in the words."""
    data, offsets = separated(column)
    inside = ~_BLANK[data]
    inside[offsets[1:] - 1] = False  # the zero byte behind each text
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    first, stop = edge[::2], edge[1::2]
    length = stop - first
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    power = np.ones(int(length.max()), np.uint64)
    power[1:] = np.cumprod(np.full(len(power) - 1, _STEP, np.uint64), dtype=np.uint64)
    # Bytes between words add nothing, so that a word's sum runs up to the next word.
    value = np.where(inside, _BYTE[data], np.uint64(0))
    gap = np.diff(np.append(first, len(data)))
    place = np.arange(first[0], len(data)) - np.repeat(first, gap)
    value = value[first[0] :] * power[np.minimum(place, len(power) - 1)]
    total = np.add.reduceat(value, first - first[0])
    return mixed(total + length.astype(np.uint64)), length, np.searchsorted(first, offsets)


def shingle_sets(column: pa.Array, width: int = 5) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted hashes; of a short text its whole sequence."""
    words, _, texts = words_of(column)
    total = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        total += words[i : i + len(total)] * _PLACE[i]
    total = mixed(total)
    out = []
    for a, b in zip(texts[:-1].tolist(), texts[1:].tolist(), strict=True):
        if b - a >= width:
            x = np.sort(total[a : b - width + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            parts = np.append(words[a:b] * _PLACE[: b - a], _PLACE[-(b - a)])
            out.append(mixed(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
