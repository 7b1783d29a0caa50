"""Token-id files: fixed blocks of ids as byte or bit planes, each plane compressed, with an index per chunk.

A file set is a folder of Parquet files without codec. A row is a chunk: whole documents, in order, until about
``CHUNK_IDS`` ids are reached. Its index columns (``part, chunk, first, n_ids, doc_ids, lengths``) say which documents and
ids it holds; ``blocks`` holds the ids, ``block_ids`` at a time (the last block of a chunk may be shorter). A block is a
matrix of ids by bits or bytes, stored plane by plane, so that equal high bits stand together; planes above the largest
id are not stored. Because chunks hold whole documents, any chunk is read without its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.llm import batches, library_tokens

BATCH_BYTES = 1 << 20
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
LEVEL = 1
BLOCK = "struct<n: int, planes: array<binary>>"
CHUNK = f"part int, chunk bigint, first bigint, n_ids bigint, kind string, doc_ids array<bigint>, lengths array<bigint>, blocks array<{BLOCK}>"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first, without those above the largest id."""
    octets = ids.astype("<u4").view(np.uint8).reshape(len(ids), 4)
    highest = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        return [np.ascontiguousarray(octets[:, i]).tobytes() for i in range(-(-highest // 8))]
    bits = np.unpackbits(octets, axis=1, bitorder="little", count=highest) if highest else octets[:, :0]
    return [p.tobytes() for p in np.packbits(bits.T, axis=1, bitorder="little")] if highest else []


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ids of a block."""
    octets = np.zeros((n, 4), dtype=np.uint8)
    if kind == "byte":
        for i, plane in enumerate(planes):
            octets[:, i] = np.frombuffer(plane, dtype=np.uint8)
    elif planes:
        packed = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes])
        bits = np.unpackbits(packed, axis=1, bitorder="little", count=n).T
        packed = np.packbits(bits, axis=1, bitorder="little")
        octets[:, : packed.shape[1]] = packed
    return octets.reshape(-1).view("<u4")


def write(
    docs: DataFrame, path: str, tokenizer: str, kind: str = "byte", end_id: int = 0, text: str = "text", doc: str = "doc_id",
    block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS,
) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending ``doc_id`` order to ``path``.

    Order is global: parts are ranges of ``doc_id`` and numbered by them. Rows with one ``doc_id`` follow each other,
    ordered by text, and may be divided over parts; a null id comes first; a null text counts as empty and holds the end
    id alone. An empty table gives a folder without rows. Other columns are not read.
    """
    if kind not in ("byte", "bit"):
        raise ValueError("kind is 'byte' or 'bit'")
    shared = docs.sparkSession.sparkContext.broadcast(library_tokens.vocabulary(tokenizer))
    arrow = pa.schema([
        ("part", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))]))),
    ])
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_tokens.encoder(*shared.value)
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal chunk, first
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            blocks = [
                {"n": len(b), "planes": [squeeze.compress(p) for p in to_planes(b, kind)]}
                for b in (ids[i : i + block_ids] for i in range(0, len(ids), block_ids))
            ]
            row = {
                "part": part, "chunk": chunk, "first": first, "n_ids": len(ids), "kind": kind, "doc_ids": list(doc_ids),
                "lengths": [len(h) // 4 for h in held], "blocks": blocks,
            }
            chunk, first = chunk + 1, first + len(ids)
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        size = 0
        for batch in batches.by_bytes(parts, "text", BATCH_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(batches.texts_of(batch, "text")), strict=True):
                doc_ids.append(doc_id)
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= chunk_ids:
                    yield close()
                    size = 0
        if held:
            yield close()

    narrow = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(pack, CHUNK).write.option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    ``start`` counts the ids of all documents before. Totals of the parts, one row each, are the only thing shared between
    tasks; ids are unpacked where their chunk is read.
    """
    chunks = spark.read.schema(CHUNK).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def unpack(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor()
        for batch in parts:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = b"".join(
                    from_planes([loosen.decompress(p) for p in b["planes"]], b["n"], row["kind"]).tobytes() for b in row["blocks"]
                )
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                starts = row["part_start"] + row["first"] + ends - lengths
                cuts = [0, *(ends * 4).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths),
                        pa.array([ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    # One row per written part: as many as the write had tasks.
    placed = chunks.join(F.broadcast(starts), "part")
    return placed.mapInArrow(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
