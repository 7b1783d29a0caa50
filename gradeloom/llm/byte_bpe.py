"""Byte-level BPE by ranks: boundaries from transition functions over code-point classes, merges from a table.

The splitting pattern is read as an automaton over code-point classes. Its only look-ahead (the last white space before a
word, the letters of a contraction) is put into the classes by comparing shifted arrays; what is left is one transition
function per character. Functions compose associatively: each stretch of ``STRETCH`` characters is folded into one
function for all stretches at once, the functions of the stretches are composed by doubling, and a last sweep with the
now known start states marks where pieces begin. A document's first character starts anew from any state, so all
documents of a batch share one array.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import batches, slices

BATCH_BYTES = 1 << 20
STRETCH = 64
TABLE_ENTRIES = 250_000
TABLE_BYTES = 64
#: Pieces from this length on are merged with a heap.
LONG_PIECE = 48

# The pattern's white space, and its contractions.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

LETTER, NUMBER, OTHER, INNER_SPACE, LAST_BLANK, LAST_SPACE, SHORT_TAIL, LONG_TAIL = range(8)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, ONE_TO_GO, TWO_TO_GO = range(8)


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER or INNER_SPACE of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    where = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, everything):
            table[where[found.start() : found.end()]] = kind
    table[list(WHITE_SPACE)] = INNER_SPACE
    return table


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece starts, by class (those of a first character after the others) and state."""
    following = np.zeros((16, 8), dtype=np.uint8)
    begins = np.ones((16, 8), dtype=bool)

    def rule(kind: int, to: int, joined: dict[int, int]) -> None:
        following[kind, :] = to
        for state, then in joined.items():
            following[kind, state], begins[kind, state] = then, False

    rule(LETTER, IN_LETTERS, {IN_LETTERS: IN_LETTERS, AFTER_BLANK: IN_LETTERS, ONE_TO_GO: FRESH, TWO_TO_GO: ONE_TO_GO})
    rule(NUMBER, IN_NUMBERS, {IN_NUMBERS: IN_NUMBERS, AFTER_BLANK: IN_NUMBERS})
    rule(OTHER, IN_OTHERS, {IN_OTHERS: IN_OTHERS, AFTER_BLANK: IN_OTHERS})
    rule(INNER_SPACE, IN_SPACE, {IN_SPACE: IN_SPACE})
    rule(LAST_BLANK, AFTER_BLANK, {})
    rule(LAST_SPACE, FRESH, {})
    rule(SHORT_TAIL, ONE_TO_GO, {IN_OTHERS: IN_OTHERS, AFTER_BLANK: IN_OTHERS})
    rule(LONG_TAIL, TWO_TO_GO, {IN_OTHERS: IN_OTHERS, AFTER_BLANK: IN_OTHERS})
    following[8:] = following[:8, [FRESH]]
    return following.reshape(-1), begins.reshape(-1)


def _classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes with look-ahead; ``first`` marks the first characters of documents."""
    kinds = _class_table()[points]
    n = len(points)
    ends = np.ones(n, dtype=bool)  # the document ends after this character
    ends[:-1] = first[1:]
    space = kinds == INNER_SPACE
    last = space.copy()
    last[:-1] &= ~space[1:]
    last &= ~ends
    kinds[last] = LAST_SPACE
    kinds[last & (points == 0x20)] = LAST_BLANK
    marks = np.flatnonzero(points == 0x27)
    marks = marks[~ends[marks]]
    after = points[marks + 1]
    kinds[marks[np.isin(after, [ord(c) for c in ONE_LETTER])]] = SHORT_TAIL
    room = ~ends[marks + 1]
    marks, after = marks[room], after[room]
    then = points[marks + 2]
    for a, b in TWO_LETTERS:
        kinds[marks[(after == ord(a)) & (then == ord(b))]] = LONG_TAIL
    kinds[first] += 8
    return kinds


def piece_starts(points: np.ndarray, first: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Whether a piece starts at each character."""
    n = len(points)
    if n == 0:
        return np.zeros(0, dtype=bool)
    following, begins = _automaton()
    rows = -(-n // stretch)
    rules = np.zeros(rows * stretch, dtype=np.uint8)
    rules[:n] = _classes(points, first)
    rules = np.ascontiguousarray(rules.reshape(rows, stretch).T) * np.uint8(8)
    folded = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in rules:
        folded = following[column[:, None] + folded]
    step = 1
    while step < rows:
        folded[step:] = np.take_along_axis(folded[step:], folded[:-step], axis=1)
        step *= 2
    state = np.zeros(rows, dtype=np.uint8)
    state[1:] = folded[:-1, FRESH]
    marks = np.empty((stretch, rows), dtype=bool)
    for j, column in enumerate(rules):
        at = column + state
        marks[j] = begins[at]
        state = following[at]
    return marks.T.reshape(-1)[:n]


def _ragged(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    return np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


class Ranks:
    """A rank file, with a bounded table of merged pieces."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        top = max(self.ranks.values(), default=-1) + 1
        bytes_of = [b""] * top
        for piece, rank in self.ranks.items():
            bytes_of[rank] = piece
        self.none = top
        self.bytes_flat, self.bytes_at, self.bytes_size = _ragged(bytes_of)
        self.decimal_flat, self.decimal_at, self.decimal_size = _ragged([b"%d," % i for i in range(top)])
        #: Ids as 32-bit numbers side by side, which take a third of what a tuple would.
        self.table: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the adjacent pair of lowest rank is joined, leftmost first, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) >= LONG_PIECE:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        none = self.none
        costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while costs:
            least = min(costs)
            if least == none:
                break
            i = costs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], none)
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        before, alive = list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != to:
                continue
            alive[end[i]] = False
            end[i] = to
            if to < n:
                before[to] = i
                if (r := ranks.get(piece[i : end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:to])) is not None:
                heapq.heappush(heap, (r, left, to))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, texts: list[str]) -> list[Encoded]:
        """Ids of each text, with the byte offset and number of ids of each piece."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        first = np.zeros(len(points), dtype=bool)
        first[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(piece_starts(points, first))
        raw = joined.encode("utf-8")
        cuts = starts
        if len(raw) > len(points):
            width = 1 + (points >= 0x80).view(np.uint8) + (points >= 0x800) + (points >= 0x10000)
            cuts = (np.cumsum(width, dtype=np.int64) - width)[starts]
        data = np.frombuffer(raw, dtype=np.uint8)
        if not len(data):
            none = np.zeros(0, dtype=np.int64)
            return [Encoded(none.astype(np.int32), none, none) for _ in texts]
        pieces, which = slices.distinct(data, cuts, np.append(cuts[1:], len(data)))
        table = self.table
        new = [p for p in pieces if p not in table]
        for piece in new:
            table[piece] = array("i", self.merge(piece)).tobytes()
        found = [table[p] for p in pieces]
        if len(table) > TABLE_ENTRIES:
            table.clear()
        else:
            for piece in new:
                if len(piece) > TABLE_BYTES:
                    del table[piece]
        flat = np.frombuffer(b"".join(found), dtype=np.int32)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // flat.itemsize
        counts = lengths[which]
        ids = slices.gather(flat, np.cumsum(lengths) - lengths, lengths, which)
        first, last = np.searchsorted(starts, ends - sizes), np.searchsorted(starts, ends)
        upto = np.concatenate(([0], np.cumsum(counts)))
        return [
            Encoded(ids[upto[a] : upto[b]], cuts[a:b] - (cuts[a] if b > a else 0), counts[a:b])
            for a, b in zip(first.tolist(), last.tolist(), strict=True)
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, dtype=np.int64)
        return slices.gather(self.bytes_flat, self.bytes_at, self.bytes_size, ids).tobytes()

    def digests(self, text: bytes) -> tuple[int, str, str, int]:
        """Number of ids, digests of the ids and of the bytes they stand for, and number of pieces, a stretch at a time."""
        n = pieces = 0
        ids, decoded = hashlib.sha256(), hashlib.sha256()
        for part in batches.stretches(text, batches.SAFE_SPACE):
            (found,) = self.encode([part.decode()])
            if n and len(found.ids):
                ids.update(b",")
            ids.update(self.decimals(found.ids))
            decoded.update(self.decode(found.ids))
            n, pieces = n + len(found.ids), pieces + len(found.offsets)
        return n, ids.hexdigest(), decoded.hexdigest(), pieces

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return slices.gather(self.decimal_flat, self.decimal_at, self.decimal_size, np.asarray(ids, dtype=np.int64)).tobytes()[:-1]


class Encoded(NamedTuple):
    """``offsets``: byte offset of each piece; ``counts``: ids of each piece."""

    ids: np.ndarray
    offsets: np.ndarray
    counts: np.ndarray

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        """Ids of the pieces that start at byte ``start`` or later and before byte ``stop``."""
        a, b = np.searchsorted(self.offsets, (start, stop))
        return self.ids[self.counts[:a].sum() : self.counts[:b].sum()]


_LOADED: dict[str, Ranks] = {}


def ranks_of(content: bytes) -> Ranks:
    """Made once per worker process."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Ranks(content)
    return _LOADED[key]


def _narrow(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, ranks_path: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Ids of every whole text: ``doc_id, ids, offsets, counts`` (byte offset and number of ids of each piece).

    No special tokens: their strings are ordinary text. A null text counts as empty and has no ids. Null or repeated
    ``doc_id`` are kept, one row out per row in; an empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(shared.value)
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            ids, offsets, counts = zip(*ranks.encode(batches.texts_of(part, "text")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "ids", "offsets", "counts"],
            )

    return _narrow(docs, doc, text).mapInArrow(run, "doc_id bigint, ids array<int>, offsets array<bigint>, counts array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Bytes of every list of ids: ``doc_id, decoded``; a null list gives no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(shared.value)
        for part in parts:
            out = [ranks.decode([] if ids is None else ids) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Encode, decode the ids, and keep digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256, n_pieces``.

    The same as :func:`encode` and :func:`decode`, without ids leaving the worker. A long text is worked through in stretches, so
    it takes a few times its size; one without a safe place to cut (a space behind another character) is encoded at once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def digest(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(shared.value)
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            if part.num_rows == 1:
                done = [ranks.digests(batches.texts_of(part, "text")[0].encode())]
            else:
                encoded = ranks.encode(batches.texts_of(part, "text"))
                sha = lambda data: hashlib.sha256(data).hexdigest()
                done = [(len(e.ids), sha(ranks.decimals(e.ids)), sha(ranks.decode(e.ids)), len(e.offsets)) for e in encoded]
            n, ids, decoded, pieces = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded), pa.array(pieces, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_pieces bigint"
    return _narrow(docs, doc, text).mapInArrow(digest, schema)
