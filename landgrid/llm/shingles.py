"""Word shingles of whole texts as 64-bit hashes, many texts at a time.

Words are runs of bytes other than blank and \\t..\\r, with A-Z in lower case. A word's hash is a polynomial of its
bytes, a shingle's one of its words' hashes, both mixed; equal shingles have equal hashes, different ones differ but for
chances of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from landgrid.llm import common

_MASK = (1 << 64) - 1


def _stream(seed: int, n: int) -> np.ndarray:
    """``n`` numbers of the splitmix64 sequence."""
    return mixed(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: a bijection that spreads the bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    _BYTE = _stream(11, 256) | np.uint64(1)
    _PLACE = _stream(13, 64) | np.uint64(1)       # factors of a word's place in a shingle
    _BASE = _stream(17, 1)[0] | np.uint64(1)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words of texts begin and end (bytes), and the number of the first word of each text (with the end)."""
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = offsets[1:-1][offsets[1:-1] < len(data)]
    first[cuts] = solid[cuts]                      # a text that ends in a word and one that begins with one
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cuts[cuts > 0] - 1] = solid[cuts[cuts > 0] - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = _BYTE[_LOWER[data] if lower else data]
    lengths = ends - starts
    # bytes are taken from the back of all words at once: the longest words, sorted last, go on
    short = lengths.astype(np.uint16) if lengths.max() < 1 << 16 else lengths        # sorted by digits
    order = np.argsort(short, kind="stable")
    sorted_lengths = lengths[order]
    at, out = starts[order], np.zeros(len(starts), np.uint64)
    most = int(sorted_lengths[-1])
    if most <= 256:
        for k in range(most):
            i = int(np.searchsorted(sorted_lengths, k, side="right"))
            out[i:] = out[i:] * _BASE + values[at[i:] + k]
    else:                                          # a word of any length by parts of powers of the base
        split = int(np.searchsorted(sorted_lengths, 256, side="right"))
        for k in range(min(256, int(sorted_lengths[split - 1]) if split else 0)):
            i = int(np.searchsorted(sorted_lengths[:split], k, side="right"))
            out[i:split] = out[i:split] * _BASE + values[at[i:split] + k]
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(most - 1, _BASE, np.uint64)]))
        for j in range(split, len(at)):
            n = int(sorted_lengths[j])
            out[j] = (values[at[j]:at[j] + n] * powers[:n][::-1]).sum(dtype=np.uint64)
    hashed = np.empty_like(out)
    hashed[order] = out
    return mixed(hashed ^ lengths.astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``width`` words, repeats included, and their offsets by text; a text with fewer words
    has its whole sequence as one, without words none."""
    n = np.diff(first)
    sizes = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1], sizes) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes)
    length = np.repeat(np.minimum(n, width), sizes)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = length > k
        if inside.all():
            total += hashes[at + k] * _PLACE[k]
        else:
            total[inside] += hashes[at[inside] + k] * _PLACE[k]
    return mixed(total ^ length.astype(np.uint64)), offsets


def distinct(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, and their offsets."""
    hashes = hashes.copy()
    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        hashes[i:j].sort()
    kept = np.ones(len(hashes), bool)
    kept[1:] = hashes[1:] != hashes[:-1]
    kept[offsets[:-1][offsets[:-1] < len(hashes)]] = True
    before = np.concatenate([[0], np.cumsum(kept)])
    return hashes[kept], before[offsets]


def shingle_sets(column: pa.Array, width: int, limit: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, hashes, offsets)`` of the shingle sets of blocks of texts."""
    data, offsets = common.utf8(column)
    for i, j in common.blocks(offsets, limit):
        block = data[offsets[i]:offsets[j]]
        starts, ends, first = words(block, offsets[i:j + 1] - offsets[i])
        yield i, j, *distinct(*shingle_hashes(word_hashes(block, starts, ends), first, width))
