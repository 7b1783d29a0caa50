"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, a passage a vector of hashed byte-trigram shares. A passage is
encoded by one tanh layer; gated attention (a tanh and a sigmoid layer, multiplied) gives each passage of a document its
weight; the weighted sum of encodings is scored. Only document labels are needed: what makes a document bad is found by
its passages' weights. Documents are scored whole, so a long one has many passages, not a cut text.

Training is fitted on a bounded sample of labelled documents (``sample_docs``), divided by hash into ``MEMBERS`` disjoint parts;
each part trains a model in a task of its own, and their scores are averaged. A lost task trains its part again and finds the
same model: seeds, order and batches are fixed.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import batches, shingles

PASSAGE_WORDS = 64
BUCKETS = 512
HIDDEN, ATTENTION = 24, 12
SAMPLE_DOCS = 8_192
MEMBERS = 2
EPOCHS, BATCH_DOCS, RATE, DECAY = 12, 64, 0.01, 1e-5
BATCH_BYTES = 1 << 18
SEED = 29

#: By place in a trigram, the part of its bucket that each byte gives.
TRIGRAM = np.random.default_rng(SEED).integers(0, BUCKETS, size=(3, 256), dtype=np.uint16)

Model = dict[str, np.ndarray]


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram shares of all passages (their square roots, and two sums of them), and the number of each text's passages.

    A text without words is one passage of zeros.
    """
    raw, first, last = shingles.joined(texts, gap=3)
    starts, _ = shingles.words(raw)
    a, b = np.searchsorted(starts, first), np.searchsorted(starts, last)
    counts = np.maximum(-(-(b - a) // PASSAGE_WORDS), 1)
    base = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(texts)), b - a)
    place = np.arange(len(starts)) - a[doc]
    n = int(counts.sum())
    # A passage reaches from its first word to the next passage, or to the text's end; bytes between belong to none.
    opens = place % PASSAGE_WORDS == 0
    begin = starts[opens]
    end = np.minimum(np.append(begin[1:], len(raw)), last[doc[opens]])
    edges = np.empty(2 * len(begin) + 1, dtype=np.int64)
    edges[:-1:2], edges[1::2], edges[-1] = begin, end, len(raw)
    rows = np.full(2 * len(begin) + 1, n, dtype=np.int32)
    rows[1:-1:2] = (base[doc] + place // PASSAGE_WORDS)[opens]
    row = np.repeat(rows, np.diff(edges, prepend=0))[: max(len(raw) - 2, 0)]
    tri = TRIGRAM[0][raw[:-2]] ^ TRIGRAM[1][raw[1:-1]] ^ TRIGRAM[2][raw[2:]]
    x = np.bincount(row * np.int32(BUCKETS) + tri, minlength=(n + 1) * BUCKETS)[: n * BUCKETS]
    x = x.astype(np.float32).reshape(n, BUCKETS)
    total = np.maximum(x.sum(axis=1, keepdims=True), 1)
    x /= total
    # How much of a passage its own trigrams repeat, and how many it has.
    extra = np.stack([np.sqrt((x * x).sum(axis=1)), (x > 0).mean(axis=1)], axis=1, dtype=np.float32)
    return np.concatenate([np.sqrt(x), extra], axis=1), counts


def start_model(seed: int) -> Model:
    rnd = np.random.default_rng(seed)

    def layer(*shape: int) -> np.ndarray:
        return (rnd.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    # Rows of the input have length 1, so the first layer starts wider.
    return {
        "w": layer(BUCKETS + 2, HIDDEN) * np.float32(8), "b": np.zeros(HIDDEN, np.float32), "v": layer(HIDDEN, ATTENTION),
        "u": layer(HIDDEN, ATTENTION), "g": layer(ATTENTION), "c": layer(HIDDEN), "c0": np.zeros(1, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def attention(m: Model, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Encodings, both gates and the raw attention of passages."""
    e = np.tanh(x @ m["w"] + m["b"])
    t, s = np.tanh(e @ m["v"]), _sigmoid(e @ m["u"])
    return e, t, s, (t * s) @ m["g"]


def forward(m: Model, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Encodings, attention and logits of bags laid one after another."""
    starts = np.cumsum(counts) - counts
    e, t, s, score = attention(m, x)
    score = np.exp(score - np.repeat(np.maximum.reduceat(score, starts), counts))
    weight = score / np.repeat(np.add.reduceat(score, starts), counts)
    z = np.add.reduceat(e * weight[:, None], starts)
    return {"e": e, "t": t, "s": s, "weight": weight, "z": z, "logit": z @ m["c"] + m["c0"], "starts": starts}


def gradients(m: Model, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> Model:
    """Of the mean log loss."""
    f = forward(m, x, counts)
    d = ((_sigmoid(f["logit"]) - y) / len(y)).astype(np.float32)
    dz = np.repeat(d, counts)[:, None] * m["c"]
    dot = (dz * f["e"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(dot * f["weight"], f["starts"]), counts)
    dscore = f["weight"] * (dot - mean)
    dt = dscore[:, None] * m["g"] * f["s"] * (1 - f["t"] ** 2)
    ds = dscore[:, None] * m["g"] * f["t"] * f["s"] * (1 - f["s"])
    de = dz * f["weight"][:, None] + dt @ m["v"].T + ds @ m["u"].T
    dh = de * (1 - f["e"] ** 2)
    return {
        "w": x.T @ dh, "b": dh.sum(axis=0), "v": f["e"].T @ dt, "u": f["e"].T @ ds,
        "g": (f["t"] * f["s"] * dscore[:, None]).sum(axis=0), "c": f["z"].T @ d, "c0": d.sum(keepdims=True),
    }


def fit(texts: list[bytes], y: np.ndarray, seed: int = SEED) -> Model:
    """A model fitted with Adam on documents in the given order."""
    rnd = np.random.default_rng(seed)
    m = start_model(seed)
    mean = {k: np.zeros_like(v) for k, v in m.items()}
    square = {k: np.zeros_like(v) for k, v in m.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rnd.permutation(len(texts))
        for at in range(0, len(order), BATCH_DOCS):
            part = order[at : at + BATCH_DOCS]
            x, counts = passages([texts[i] for i in part])
            step += 1
            for k, g in gradients(m, x, counts, y[part]).items():
                g = g + DECAY * m[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                m[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-7)
    return m


def scores(models: list[Model], texts: list[bytes]) -> np.ndarray:
    """Mean probability of label 1; 0.5 where there is no model."""
    if not models or not texts:
        return np.full(len(texts), 0.5)
    if len(texts) == 1 and len(texts[0]) > batches.LONG_BYTES:
        return np.array([long_score(models, texts[0])])
    x, counts = passages(texts)
    return np.mean([_sigmoid(forward(m, x, counts)["logit"].astype(np.float64)) for m in models], axis=0)


def slabs(text: bytes) -> Iterator[bytes]:
    """A text in stretches of whole passages."""
    held = b""
    for part in batches.stretches(text, batches.WHITE):
        held += part
        starts, _ = shingles.words(np.frombuffer(held, dtype=np.uint8))
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS
        if whole > 0:
            yield held[: starts[whole]]
            held = held[starts[whole] :]
    yield held


def long_score(models: list[Model], text: bytes) -> float:
    """:func:`scores` of one text, a slab of passages at a time: each model keeps its largest attention, the sum of weights
    relative to that, and the weighted sum of encodings."""
    largest, weights = np.full(len(models), -np.inf), np.zeros(len(models))
    sums = np.zeros((len(models), HIDDEN))
    for slab in slabs(text):
        x, _ = passages([slab])
        for i, m in enumerate(models):
            e, _, _, score = attention(m, x)
            top = max(largest[i], float(score.max()))
            before, now = np.exp(largest[i] - top), np.exp(score - top)
            weights[i] = weights[i] * before + now.sum()
            sums[i] = sums[i] * before + now @ e
            largest[i] = top
    logits = [z / w @ m["c"] + m["c0"][0] for m, z, w in zip(models, sums, weights, strict=True)]
    return float(np.mean([_sigmoid(x) for x in logits]))


def _narrow(docs: DataFrame, doc: str, text: str) -> DataFrame:
    text_col = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8")
    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), text_col.alias("text"))


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS, members: int = MEMBERS,
) -> list[Model]:
    """Models fitted on at most ``sample_docs`` labelled documents that are not held out.

    The sample is those with the lowest hashes of their id. Null labels and ids are passed over; of several labels of one
    document the lowest counts; of several texts of one document the first in byte order is used. Without labelled documents there is no model.
    """
    known = labels.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    # At most sample_docs rows of two numbers.
    rows = _narrow(docs, doc, text).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = rows.withColumn("member", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(members)))

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        model = fit(part["text"].tolist(), part["y"].to_numpy(dtype=np.float32))
        return pd.DataFrame({"member": part["member"].iloc[:1], "model": [pickle.dumps(model)]})

    fitted = rows.groupBy("member").applyInPandas(one, "member bigint, model binary")
    return [pickle.loads(r.model) for r in sorted(fitted.collect())]


def score(docs: DataFrame, models: list[Model], text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; one row per row, null texts count as empty.

    ``text_key`` follows, the 64-bit hash of the text, which tells rows that repeat an id apart.

    An empty text is one passage without trigrams and gets the score of that. Without models every score is 0.5. An empty
    table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            found = scores(shared.value, part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.float64()), part.column("text_key")], ["doc_id", "score", "text_key"]
            )

    keyed = _narrow(docs, doc, text).withColumn("text_key", F.xxhash64(F.col("text").cast("string")))
    scored = keyed.mapInArrow(run, "doc_id bigint, score double, text_key bigint")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_key")


def passage_weights(docs: DataFrame, models: list[Model], text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``doc_id, weights``: the mean attention of each passage, in the text's order."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.by_bytes(parts, "text", BATCH_BYTES):
            x, counts = passages(part.column("text").to_pylist())
            weight = np.mean([forward(m, x, counts)["weight"] for m in shared.value], axis=0).astype(np.float64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(weight))], ["doc_id", "weights"]
            )

    return _narrow(docs, doc, text).mapInArrow(run, "doc_id bigint, weights array<double>")
