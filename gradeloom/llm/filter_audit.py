"""Audit of how filters interact: what each removes, in every order they could be applied in.

Every document gets a mask of the filters it fails. Per part, documents are counted by mask: at most ``2 ** filters`` cells,
whatever the number of documents. A Gray-code walk then visits all subsets of filters, toggling one at a time: each cell
counts how many active filters it fails, and the running survivors change by the cells whose counter leaves or reaches zero.
The survivors of every subset are stored; a step of an order is the difference of two of them.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import batches
from gradeloom.plans.skew import hot_key_join, lookup_join, materialize

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: Bytes of a slice of documents, of a stretch of a long text, and of the words told apart at a time.
BATCH_BYTES, STRETCH_BYTES, SET_BYTES = 1 << 22, 1 << 20, 1 << 23
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes to leave out when counting: capitals, marks, and all but the first byte of a character.
CAPITALS, MARKS, TAILS = bytes(range(0x41, 0x5B)), b"#$%&*|", bytes(range(0x80, 0xC0))
DIGEST_BYTES = 16
MEASURES = ("n", "good", "toxic")


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text cut at white space; a word longer than a stretch stays whole."""
    at = 0
    while len(text) - at > STRETCH_BYTES:
        space = SPACE.search(text, at + STRETCH_BYTES)
        if space is None:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


def word_numbers(text: bytes, set_bytes: int = SET_BYTES) -> tuple[int, int]:
    """Words and distinct words of a text, exactly.

    Words of a long text are told apart in several passes, each over the words of one remainder, so that a set holds about
    ``set_bytes`` of them.
    """
    if len(text) <= STRETCH_BYTES:
        words = text.split()
        return len(words), len(set(words))
    passes = math.ceil(len(text) / set_bytes)
    total = distinct = 0
    for turn in range(passes):
        seen: set[bytes] = set()
        for stretch in _stretches(text):
            words = stretch.split()
            total += len(words) if turn == 0 else 0
            seen.update(words if passes == 1 else (w for w in words if zlib.crc32(w) % passes == turn))
        distinct += len(seen)
    return total, distinct


def failure_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; E depends on other documents."""
    words, distinct = word_numbers(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, TAILS))
    fails = (
        words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * words,
        100 * capitals > MOST_CAPITALS * points,
        len(text.translate(None, MARKS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def failures(docs: DataFrame, text: str = "text", doc: str = "doc_id", part: str = "source") -> DataFrame:
    """``doc_id, part, digest, mask`` of every document: the filters A to D it fails, and a digest of its text.

    A null text counts as empty, a null part as the empty string. Other columns are not read.
    """

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches.by_bytes(parts, "text", BATCH_BYTES):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            digests = [hashlib.blake2b(t, digest_size=DIGEST_BYTES).digest() for t in texts]
            masks = pa.array([failure_mask(t) for t in texts], pa.int32())
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), masks]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "digest", "mask"])

    narrow = docs.select(
        F.col(doc).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"),
    )
    return narrow.mapInArrow(run, "doc_id bigint, part string, digest binary, mask int")


def mask_cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail, E included.

    E fails where a smaller id has the same text. All but the smallest id of a text fail it, so a text is reduced to one row
    per part before its ids are compared; a document without id is never a copy. ``labels (doc_id, quality, toxic)`` may
    repeat an id: one row that says so is enough.
    """
    marked = (F.col("quality") == 1) | (F.col("toxic") == 1)
    said = (
        labels.filter(marked & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(*[F.coalesce(F.max((F.col(c) == 1).cast("bigint")), F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    )
    failed = materialize(failed, "filter-failures")
    zero = F.lit(0).cast("bigint")
    counted = failed.select("*", F.lit(1).cast("bigint").alias("n"), zero.alias("good"), zero.alias("toxic"))
    labelled = hot_key_join(failed.filter("doc_id IS NOT NULL"), said, "doc_id", ["digest"])
    both = counted.unionByName(labelled.select(*failed.columns, zero.alias("n"), "good", "toxic"))

    sums = [F.sum(m).alias(m) for m in MEASURES]
    per_id = both.groupBy("digest", "mask", "part", "doc_id").agg(*sums)
    named = F.col("doc_id").isNotNull()
    first = F.min(F.when(named, F.struct("doc_id", *MEASURES))).alias("first")
    nameless = [F.sum(F.when(named, 0).otherwise(F.col(m))).alias(f"{m}_nameless") for m in MEASURES]
    per_text = per_id.groupBy("digest", "mask", "part").agg(*sums, first, *nameless)
    least = per_text.groupBy("digest").agg(F.min("first.doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    shared = least.filter("rows > 1").select("digest", "least")
    placed = lookup_join(per_text, shared, ["digest"], ["part"], "left", "shared-texts")

    is_first = F.col("first.doc_id") == F.coalesce("least", "first.doc_id")
    passing = {m: F.when(is_first, F.col(f"first.{m}")).otherwise(0) + F.col(f"{m}_nameless") for m in MEASURES}
    copy_bit = 1 << FILTERS.index("E")
    cells = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), *[c.alias(m) for m, c in passing.items()]),
            F.struct((F.col("mask") + copy_bit).alias("mask"), *[(F.col(m) - c).alias(m) for m, c in passing.items()]),
        )
    )
    return placed.select("part", cells.alias("cell")).select("part", "cell.*").groupBy("part", "mask").agg(*sums)


def subset_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, from ``cells`` by mask of failed filters; further axes are measures."""
    size = len(cells)
    masks = np.arange(size)
    active_failures = np.zeros(size, dtype=np.int64)
    states = np.empty_like(cells)
    survivors = cells.sum(axis=0)
    states[0] = survivors
    active = 0
    for step in range(1, size):
        bit = step & -step
        active ^= bit
        failing = (masks & bit) != 0
        if active & bit:
            survivors = survivors - cells[failing & (active_failures == 0)].sum(axis=0)
            active_failures[failing] += 1
        else:
            active_failures[failing] -= 1
            survivors = survivors + cells[failing & (active_failures == 0)].sum(axis=0)
        states[active] = survivors
    return states


class _Orders:
    """All orders of the filters: per step, its filter and the subsets before and after it."""

    def __init__(self, filters: str):
        orders = np.array(list(itertools.permutations(range(len(filters)))))
        self.filters, self.names = filters, ["".join(filters[i] for i in order) for order in orders]
        self.which = orders.ravel()
        after = np.cumsum(1 << orders, axis=1)
        self.after, self.before = after.ravel(), (after - (1 << orders)).ravel()
        self.steps = len(filters)
        self.bits = 1 << np.arange(len(filters))

    def rows(self, cells: np.ndarray) -> dict[str, np.ndarray]:
        """Columns of the report, a row per order and step."""
        states = subset_states(cells)
        gone = states[self.before] - states[self.after]
        masks = np.arange(len(cells))
        fails = np.array([cells[(masks & b) != 0, 0].sum() for b in self.bits])
        shapley = np.zeros(len(self.bits), dtype=np.int64)
        np.add.at(shapley, self.which, gone[:, 0])
        return {
            "kept": states[self.after][:, 0],
            "removed": gone[:, 0],
            "redundant": fails[self.which] - gone[:, 0],
            "unique_fails": cells[self.bits, 0][self.which],
            "good_lost": gone[:, 1],
            "toxic_lost": gone[:, 2],
            "shapley": shapley[self.which],
        }


REPORT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def order_report(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, filter_order, step`` and counts, for every part, order of ``filters`` and step, from ``cells`` by mask.

    Bit i of a mask stands for the i-th filter. Parts are handled one by one, each from its cells alone. No parts, no rows.
    """
    size = 1 << len(filters)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _Orders(filters)
        n = len(orders.which)
        names = pa.array(np.repeat(orders.names, orders.steps), pa.string())
        steps = pa.array(np.tile(np.arange(1, orders.steps + 1), n // orders.steps), pa.int32())
        for batch in parts:
            for part, cell_list in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                cells = np.zeros((size, len(MEASURES)), dtype=np.int64)
                for cell in cell_list:
                    cells[cell["mask"]] = [cell[m] for m in MEASURES]
                found = orders.rows(cells)
                counts = [pa.array(found[c], pa.int64()) for c in REPORT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.string()), names, steps, *counts], ["part", "filter_order", "step", *REPORT]
                )

    grouped = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in REPORT)
    return grouped.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the filters A to E remove from each source of ``docs``, in all 120 orders.

    A: under 50 words. B: fewer than 65 distinct words per 100. C: more than 5 capitals A-Z per 100 code points. D: one of
    ``#$%&*|``. E: a smaller id has the same text (compared by 128-bit digests).

    A null text counts as empty and a null source as the empty string. Without ``doc_id`` a document has no labels and is
    neither a copy nor the original of one; repeated rows count each, those with the smallest id of their text pass E. An empty
    table gives an empty result. Extra columns are not read.
    """
    return order_report(mask_cells(failures(docs), labels))
