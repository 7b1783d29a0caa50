"""Token counts: batches balanced by bytes, encoded by the library; only lengths come back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import batches, library_tokens

BATCH_BYTES = 1 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", doc: str = "doc_id", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Bytes and tokens of every text: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file. No begin, end or added
    special tokens; special strings inside a text count as the library counts them; nothing is truncated.

    A null text counts as empty: 0 bytes, 0 tokens. A null or repeated ``doc_id`` is kept as it is, one row out per row in.
    An empty table gives an empty result. Other columns are not read, so their names cannot clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(library_tokens.vocabulary(tokenizer))

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_tokens.encoder(*shared.value)
        for part in batches.by_bytes(parts, "text", batch_bytes):
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            n = pa.array(encoder.counts(batches.texts_of(part, "text")), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, n], ["doc_id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = narrow.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
