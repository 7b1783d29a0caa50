"""Word shingles of whole texts as 64-bit hashes, for all documents of a batch at once."""

from __future__ import annotations

import numpy as np

from gradeloom.llm import batches, slices


def _weights(n: int) -> np.ndarray:
    return np.random.default_rng(71).integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def joined(texts: list[bytes], gap: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with spaces between them, and where each starts and ends."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes + gap) - sizes - gap
    return np.frombuffer((b" " * gap).join([*texts, b""]), dtype=np.uint8), starts, starts + sizes


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without the white space 0x20, 0x09 to 0x0D."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and the number of each text's.

    A long text that is alone is worked through in stretches of words. A-Z are lower-cased. A text with fewer than ``width`` words has its whole sequence as one shingle, one without words
    has none.
    """
    if len(texts) == 1 and len(texts[0]) > 2 * batches.LONG_BYTES:
        return _long_set(texts[0], width)
    return shingle_sets_at_once(texts, width)


def shingle_sets_at_once(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` of texts that fit side by side."""
    raw, first, last = joined(texts)
    raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint8(32), raw)
    starts, ends = words(raw)
    keys = np.append(slices.keys(raw, starts, ends), np.zeros(width, dtype=np.uint64))
    a, b = np.searchsorted(starts, first), np.searchsorted(starts, last)
    doc = np.repeat(np.arange(len(texts)), b - a)
    at = np.arange(len(starts))
    left = b[doc] - at  # words from here to the document's end
    whole = (left >= width) | (at == a[doc])
    at, doc, left = at[whole], doc[whole], np.minimum(left[whole], width)
    total = left.astype(np.uint64) * np.uint64(slices.BASE)
    for j, weight in enumerate(_weights(width)):
        total += np.where(left > j, keys[at + j] * weight, np.uint64(0))
    hashes = slices.mix(total)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[fresh], np.bincount(doc[fresh], minlength=len(texts))


def _long_set(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` of one text; a stretch takes over the last words before it, so no shingle is missed."""
    found, held = np.zeros(0, dtype=np.uint64), b""
    for part in batches.stretches(text, batches.WHITE):
        held = held + b" " + part if held else part
        last = held.rsplit(None, width)
        if len(last) <= width:  # not enough words for a shingle yet, or just one
            continue
        hashes, _ = shingle_sets_at_once([held], width)
        found = np.union1d(found, hashes)
        held = b" ".join(last[1:])
    if not len(found) or len(held.split()) >= width:
        found = np.union1d(found, shingle_sets_at_once([held], width)[0])
    return found, np.array([len(found)])
