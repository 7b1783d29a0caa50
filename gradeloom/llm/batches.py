"""Arrow batches cut into slices of about equal text bytes, and long texts cut into stretches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices holding at most ``limit`` bytes of ``column``, or one row that alone is longer."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


#: Texts above this many bytes are worked through in stretches of about that size.
LONG_BYTES = 1 << 20
WHITE = re.compile(rb"[\x20\x09-\x0d]")
#: A space behind a character that is not white space, in UTF-8: byte-level pre-tokenizers always begin a piece there.
SAFE_SPACE = re.compile(
    rb"(?<![\x09-\x0d\x1c-\x20])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80) "
)


def stretches(text: bytes, cut: re.Pattern, size: int = LONG_BYTES) -> Iterator[bytes]:
    """The text cut in front of a match of ``cut`` after every ``size`` bytes or more; without one the rest stays whole."""
    at = 0
    while len(text) - at > size:
        place = cut.search(text, at + size)
        if place is None:
            break
        yield text[at : place.start()]
        at = place.start()
    yield text[at:] if at else text


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
