"""Slices of a byte array: keys for grouping equal ones, and gathering of ragged values."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the rolling key, and the seed of the table that spreads single bytes.
BASE = 0x9E3779B97F4A7C15
BYTE_SEED = 20240229

#: Exponents start again after so many bytes, so that the tables of powers have a fixed size.
CHUNK = 1 << 16


def _powers(base: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64 for exponents up to ``CHUNK``."""
    steps = np.full(CHUNK + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_up, _down = _powers(BASE), _powers(pow(BASE, -1, 2**64))
_spread = np.random.default_rng(BYTE_SEED).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Multipliers of the 64-bit finalizer.
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * MIX[1]
    return x ^ (x >> np.uint64(33))


def keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of ``raw[start:end]``: equal slices have equal keys, whatever their place.

    Works in eight bytes per byte of ``raw``; a slice that runs over several chunks is added up chunk by chunk.
    """
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    for at in range(0, len(raw), CHUNK):
        part = raw[at : at + CHUNK]
        np.multiply(_spread[part], _up[: len(part)], out=sums[at + 1 : at + 1 + len(part)])
    np.cumsum(sums, out=sums)
    stops = np.minimum(ends, (starts | (CHUNK - 1)) + 1)
    value = (sums[stops] - sums[starts]) * _down[starts & (CHUNK - 1)]
    left = np.flatnonzero(stops < ends)
    at, factor = stops[left], _up[(stops - starts)[left]]
    while len(left):
        stops = np.minimum(ends[left], at + CHUNK)
        value[left] += (sums[stops] - sums[at]) * factor
        more = stops < ends[left]
        left, at, factor = left[more], stops[more], factor[more] * _up[CHUNK]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(BASE))


def distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and for each slice its number among them."""
    _, first, which = np.unique(keys(raw, starts, ends), return_index=True, return_inverse=True)
    data = raw.tobytes()
    return [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], which


def gather(values: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ragged rows ``values[offsets[w] : offsets[w] + lengths[w]]`` for each w, one after another."""
    sizes = lengths[which]
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(offsets[which] - before, sizes) + np.arange(total, dtype=np.int64)]


def totals(sizes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of ``sizes[first:last]``."""
    sums = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=sums[1:])
    return sums[last] - sums[first]
