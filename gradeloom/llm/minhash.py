"""Near-duplicate documents by b-bit MinHash, with every link confirmed on full shingle sets.

1. Each document gets ``KEPT`` minima. The first ``BANDS * ROWS`` are hashed by bands; of each minimum only the low ``BITS`` bits
   are kept, packed into 64-bit words. Documents with equal shingle sets are one class, stood for by its smallest id.
2. Classes that share a band are candidates. The share of equal low bits, counted with ``bit_count`` on the packed words
   and corrected for chance agreement (2**-BITS), estimates the similarity; candidates whose estimate is ``SLACK``
   standard errors below the threshold are let go.
3. What is left is confirmed by exact intersection of the sets of 64-bit shingle hashes.

Groups of thousands of near copies are not expanded into pairs. First every class is compared with a hub of each of its
bands. Bands whose classes are then all in one component need nothing more; where many pairs across components are
left, other hubs are tried; what is still divided is compared pair by pair across components inside the join, which
emits only pairs whose estimate passes. So no link between components is lost, whatever the size of a band.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gradeloom.llm import batches, shingles, slices
from gradeloom.llm.components import connected_components
from gradeloom.plans.skew import lookup_join, materialize, materialize_measured

BANDS, ROWS, BITS = 32, 4, 2
#: Minima whose low bits are kept; the first BANDS * ROWS of them make the bands.
KEPT = 256
SLACK = 5.0
BATCH_BYTES = 1 << 20
#: Hubs a group of bands has in one turn, and the turns there are at most before all pairs across components are looked at;
#: that comes sooner when there are no more of them than so many for each row.
HUBS, HUB_TURNS, CROSS_PER_ROW = 3, 3, 1_024
ROWS_PER_FILE = 50_000
SEED = 8191

SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, low_bits array<bigint>, bands array<bigint>, text_key bigint"


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists of 64-bit integers."""
    rows, width = values.shape
    flat = pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), flat)


def signatures(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """Set sizes, two set digests, packed low bits and band keys; documents without shingles have zeros."""
    hashes, sizes = shingles.shingle_sets(texts, width)
    n, k = len(texts), KEPT
    digests = np.zeros((2, n), dtype=np.uint64)
    packed = np.zeros((n, k * BITS // 64), dtype=np.uint64)
    bands = np.zeros((n, BANDS), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        for i, salt in enumerate(_odd(2, SEED)):
            digests[i, full] = np.add.reduceat(slices.mix(hashes ^ salt), starts)
        minima = np.empty((k, len(full)), dtype=np.uint64)
        for i, (a, b) in enumerate(zip(_odd(k, SEED + 1), _odd(k, SEED + 2), strict=True)):
            minima[i] = np.minimum.reduceat(hashes * a + b, starts)
        minima = slices.mix(minima)
        lanes = 64 // BITS
        for i in range(k):
            low = minima[i] & np.uint64(2**BITS - 1)
            packed[full, i // lanes] |= low << np.uint64(BITS * (i % lanes))
        weights = _odd(ROWS, SEED + 3)
        for band in range(BANDS):
            rows = minima[band * ROWS : (band + 1) * ROWS]
            bands[full, band] = slices.mix((rows * weights[:, None]).sum(axis=0, dtype=np.uint64) + np.uint64(band))
    return sizes, digests[0].view(np.int64), digests[1].view(np.int64), packed, bands


def _narrow(docs: DataFrame, doc: str, text: str) -> DataFrame:
    text_col = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8")
    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), text_col.alias("text"))


def sign(docs: DataFrame, width: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Signatures of all documents, with the hash of the text."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            sizes, a, b, packed, bands = signatures(part.column("text").to_pylist(), width)
            columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a), pa.array(b), _lists(packed), _lists(bands), part.column("text_key")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "low_bits", "bands", "text_key"])

    keyed = _narrow(docs, doc, text).withColumn("text_key", F.xxhash64(F.col("text").cast("string")))
    return keyed.mapInArrow(run, SIGNED)


def shingle_rows(docs: DataFrame, width: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``doc_id, shingles``: the full set of each document as sorted 64-bit hashes."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            hashes, sizes = shingles.shingle_sets(part.column("text").to_pylist(), width)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "shingles"])

    return _narrow(docs, doc, text).mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def estimate(x: str, y: str) -> Column:
    """Similarity from the equal low bits of two packed columns, corrected for chance agreement."""
    chance = 2.0**-BITS
    k = KEPT
    lanes = F.lit(sum(1 << (BITS * i) for i in range(64 // BITS))).cast("bigint")
    unequal: Column = F.lit(0)
    for word in range(k * BITS // 64):
        differ = F.col(x)[word].bitwiseXOR(F.col(y)[word])
        folded = differ
        for bit in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differ, bit))
        unequal = unequal + F.bit_count(folded.bitwiseAND(lanes))
    agree = (F.lit(float(k)) - unequal) / F.lit(float(k))
    return (agree - chance) / (1 - chance)


def lowest_estimate(percent: int) -> float:
    """Estimates from here on may belong to a similarity of ``percent`` or more."""
    chance, k = 2.0**-BITS, KEPT
    agree = chance + (1 - chance) * percent / 100
    return percent / 100 - SLACK * sqrt(agree * (1 - agree) / k) / (1 - chance)


def similar(percent: int) -> Column:
    """Whether the sets ``set_a`` and ``set_b`` are ``percent`` similar or more."""
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (100 + percent) * shared >= percent * (F.size("set_a") + F.size("set_b"))


def sets_of(asked: DataFrame, docs: DataFrame, width: int, text: str, doc: str) -> DataFrame:
    """The shingle sets of the asked documents, made again from their texts, so that they are stored for no other."""
    asked, small = materialize_measured(asked, "asked")
    sets = shingle_rows(_narrow(docs, doc, text).join(F.broadcast(asked) if small else asked, "doc_id", "left_semi"), width, "text", "doc_id")
    return materialize(sets, "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar. Where a hub has very many pairs, adaptive execution divides the joins."""
    one = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    two = one.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    return two.filter(similar(percent)).select("a", "b")


def hub_pairs(rows: DataFrame, turn: int, least: float) -> DataFrame:
    """``a, b``: each row of ``rows (band, doc_id, component, low_bits)`` and the hub of its band, unless their components are one.

    A band's hub is the document with the lowest hash under one of ``HUBS`` seeds: bands with the same documents have few hubs.
    """
    order = F.xxhash64("doc_id", F.lit(turn), F.pmod("band", F.lit(HUBS)))
    hubs = rows.groupBy("band").agg(F.min(F.struct(order.alias("o"), "doc_id", "component", "low_bits")).alias("hub"))
    met = rows.join(hubs, "band").filter("component <> hub.component").withColumn("hub_bits", F.col("hub.low_bits"))
    met = met.filter(estimate("low_bits", "hub_bits") >= least)
    return met.select(F.greatest("doc_id", "hub.doc_id").alias("a"), F.least("doc_id", "hub.doc_id").alias("b")).distinct()


def cross_links(rows: DataFrame, shape: DataFrame, sets: DataFrame, least: float, percent: int) -> DataFrame:
    """``a, b``: all similar pairs of one band and different components, each from the first band they share.

    Estimate and sets are compared inside the join, so that pairs that are not similar are never rows.
    """
    rows = rows.join(shape.select("doc_id", "bands"), "doc_id").join(sets, "doc_id")
    # Both sides are the same columns, all of them used, so that one shuffle serves both.
    columns = {"doc_id": "", "component": "c", "low_bits": "bits_", "bands": "bands_", "shingles": "set_"}
    x, y = (rows.select("band", "at", *[F.col(name).alias(f"{short}{side}") for name, short in columns.items()]) for side in ("b", "a"))
    earlier = F.zip_with(F.slice("bands_a", F.lit(1), x["at"]), F.slice("bands_b", F.lit(1), x["at"]), lambda p, q: p == q)
    across = (x["band"] == y["band"]) & (x["at"] == y["at"]) & (F.col("cb") < F.col("ca")) & (estimate("bits_a", "bits_b") >= least)
    across = across & ~F.exists(earlier, lambda same: same) & similar(percent)
    return x.join(y, across).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def open_bands(buckets: DataFrame, groups: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows of bands that hold several components, their number, and how many pairs across components they make."""
    known = groups.select(F.col("node").alias("doc_id"), "component")
    placed = buckets.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    cross = (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2
    divided = parts.groupBy("band").agg(F.count(F.lit(1)).alias("parts"), cross.alias("cross"), F.sum("n").alias("rows")).filter("parts > 1")
    seen = Observation()
    divided = materialize(divided.observe(seen, F.sum("cross").alias("cross"), F.sum("rows").alias("rows")).select("band"), "open")
    rows, pairs = int(seen.get["rows"] or 0), int(seen.get["cross"] or 0)
    return placed.join(divided, "band", "left_semi"), rows, pairs


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept, text_key``.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct ``width``-word shingles, held
    as 64-bit hashes; ``component_id`` is the smallest id reachable by links, and the document that has it is kept.
    ``text_key`` is the 64-bit hash of the text.

    A null or empty text, or one without words, has no shingles and is linked with nothing. Rows that repeat an id with
    another text are documents of their own; of several such rows with a component's smallest id one is kept. Rows that
    repeat id and text are one document and stay or go together. A null ``doc_id`` is linked with nothing, has no component
    and is kept. An empty table gives an empty result. Other columns are not read.
    """
    of = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{doc}`").cast("bigint").alias("doc_id"), of.alias("text"), F.xxhash64(of).alias("text_key"))
    odd = keyed.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    odd = odd.agg(F.bool_or(F.col("doc_id").isNotNull()).alias("repeated"), F.bool_or(F.col("doc_id").isNull()).alias("nameless")).first()
    named = keyed.filter("doc_id IS NOT NULL") if odd.nameless else keyed
    linked = _linked_again(named, width, percent) if odd.repeated else _linked(named, width, percent)
    if not odd.nameless:
        return linked
    alone = sign(keyed.filter("doc_id IS NULL"), width).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_key"
    )
    return linked.unionByName(alone)


def _linked_again(keyed: DataFrame, width: int, percent: int) -> DataFrame:
    """:func:`_linked` of documents whose ids repeat."""
    # Ids that repeat: the text with the smallest hash keeps the id as its node, further ones get nodes of their own.
    first = keyed.groupBy("doc_id").agg(F.min("text_key").alias("first_key"))
    placed = lookup_join(keyed.select("doc_id", "text_key"), first, ["doc_id"], ["text_key"], label="first-texts")
    own = F.col("text_key") == F.col("first_key")
    nodes = placed.withColumn("node", F.when(own, F.col("doc_id")).otherwise(F.xxhash64("doc_id", "text_key", F.lit("again"))))
    nodes = materialize(nodes.groupBy("node", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")), "nodes")
    same = (keyed["doc_id"] == nodes["doc_id"]) & (keyed["text_key"] == nodes["text_key"])
    unique = keyed.join(nodes, same).select(nodes["node"].alias("doc_id"), keyed["text"], keyed["text_key"]).dropDuplicates(["doc_id"])
    linked = _linked(unique, width, percent).select(F.col("doc_id").alias("node"), "n_shingles", F.col("component_id").alias("part"))
    members = materialize(nodes.join(linked, "node"), "members")
    stays = F.min(F.struct("doc_id", F.col("node") != F.col("doc_id"), "node"))
    parts = members.groupBy("part").agg(F.min("doc_id").alias("component_id"), stays["node"].alias("stays"))
    rows = members.join(parts, "part").withColumn("kept", F.col("node") == F.col("stays"))
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), "rows"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept", "text_key", again.alias("row")).drop("row")


def _linked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """:func:`near_duplicates` of ``docs (doc_id, text, text_key)`` whose ids are unique and not null."""
    text, doc = "text", "doc_id"
    signed = materialize(sign(docs, width, text, doc), "signatures")
    full = signed.filter("n_shingles > 0")
    content = ["set_a", "set_b", "n_shingles"]
    classes = full.groupBy(*content).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "classes")
    # A class's smallest id has its signature.
    shape = full.select("doc_id", *content, "low_bits", "bands").join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *content], "left_semi")
    rows = shape.select("doc_id", "low_bits", F.posexplode("bands").alias("at", "band"))
    several = rows.groupBy("band").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    seen = Observation()
    buckets = rows.join(several.select("band"), "band", "left_semi").observe(seen, F.count(F.lit(1)).alias("rows"))
    buckets = materialize(buckets, "bands")
    # Links and pairs are no more than the rows of bands; few of them need few files.
    files = 1 + seen.get["rows"] // ROWS_PER_FILE
    least = lowest_estimate(percent)
    both = F.explode(F.array("a", "b")).alias("doc_id")

    open_rows = buckets.withColumn("component", F.col("doc_id"))
    links = tried = groups = None
    for turn in range(HUB_TURNS):
        pairs = hub_pairs(open_rows, turn, least)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs.coalesce(files), "candidates")
        tried = pairs if tried is None else tried.unionByName(pairs)
        sets = sets_of(pairs.select(both).distinct().coalesce(files), docs, width, text, doc)
        found = materialize(confirm(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        groups = connected_components(links, files)
        open_rows, n, left = open_bands(buckets, groups)
        if left <= CROSS_PER_ROW * n:
            break
    if left:
        open_rows = materialize(open_rows, "open-rows")
        sets = sets_of(open_rows.select("doc_id").distinct().coalesce(files), docs, width, text, doc)
        found = materialize(cross_links(open_rows, shape, sets, least, percent), "links")
        groups = connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found), files)

    # Members of a class follow the document that stands for it.
    moved = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    moved = moved.filter("copies > 1 OR component IS NOT NULL").select(*content, F.coalesce("component", "rep").alias("component_id"))
    out = full.select("doc_id", "text_key", *content).join(moved, content, "left").select("doc_id", "n_shingles", "component_id", "text_key")
    alone = signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key")
    out = out.unionByName(alone).withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "text_key")
