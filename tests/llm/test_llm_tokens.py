import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeloom.llm import byte_bpe, library_tokens, plane_files, token_counts
from gradeloom.session import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "  ", "\n\n a", "a  b", "it's we'll 'tis don''t '", "x<|endoftext|>y <|endoftext|>", "éa  b　 c", "a" * 3000,
    "word " * 5000, "12 345\t6\r\n7", "same", "same", "中文字 한국어 \U0001f600\U0001f600", "\x1c a\x85 b  c", "end ",
]
WORDS = ["re", "ve", "'s", "'ll", " ", "  ", "\n", "é", "x", "12", "!?", " ", "'", "don't", "<|endoftext|>"]


def rows(spark, texts):
    data = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id bigint, text string, n_tokens string, start int")


def random_texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def library():
    return Tokenizer.from_file(JSON)


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_are_those_of_the_library(spark):
    texts = TEXTS + random_texts(300)
    got = {r.doc_id: r for r in token_counts.token_counts(rows(spark, texts), JSON, limit=100, batch_bytes=500).collect()}
    for i, e in enumerate(library().encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((texts[i] or "").encode()), len(e.ids), len(e.ids) > 100)


def test_counts_of_other_vocabularies():
    from sentencepiece import SentencePieceProcessor

    texts = ["Two Words", "", "a  b\nc", "ÉTÉ été"]
    lower = public_tokenizers.path("word_bpe_49k.json")
    encoder = library_tokens.encoder(*library_tokens.vocabulary(lower))
    assert not encoder.cuts
    assert encoder.counts(texts) == [len(e.ids) for e in Tokenizer.from_file(lower).encode_batch(texts, add_special_tokens=False)]
    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = SentencePieceProcessor(model_file=model)
    assert library_tokens.encoder(*library_tokens.vocabulary(model)).counts(texts) == [len(plain.encode(t)) for t in texts]
    with pytest.raises(ValueError):
        library_tokens.encoder(b"", "txt")


def test_a_full_table_is_emptied(monkeypatch):
    monkeypatch.setattr(library_tokens, "TABLE_ENTRIES", 3)
    encoder = library_tokens.Encoder(*library_tokens.vocabulary(JSON))
    texts = ["a b c d e f", "a b c d e f g"]
    want = [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]
    assert encoder.counts(texts) == want and not encoder.table and encoder.counts(texts) == want


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [255, 256], [50256, 1, 70000], list(range(0, 40000, 7))])
def test_planes_round_trip(kind, ids):
    ids = np.array(ids, dtype="<u4")
    planes = plane_files.to_planes(ids, kind)
    assert plane_files.from_planes(planes, len(ids), kind).tolist() == ids.tolist()
    if kind == "bit" and len(ids):
        assert len(planes) == int(ids.max()).bit_length()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_plane_files_hold_all_ids_in_order(spark, kind):
    texts = TEXTS + random_texts(40, 5)
    docs = rows(spark, texts).repartition(5)
    path = scratch_path(spark, "planes-test")
    plane_files.write(docs, path, JSON, kind=kind, block_ids=64, chunk_ids=200)
    got = sorted(plane_files.read(spark, path).withColumn("crc", F.crc32("ids")).collect())
    start = 0
    for row, e in zip(got, library().encode_batch([t or "" for t in texts], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 0], dtype="<u4").tobytes()
        assert (row.start, row.n_tokens, bytes(row.ids), row.crc) == (start, len(e.ids) + 1, ids, zlib.crc32(ids))
        start += row.n_tokens
    chunks = spark.read.parquet(path)
    assert chunks.count() > 3 and chunks.filter("size(filter(blocks, b -> b.n > 64)) > 0").count() == 0


def test_plane_files_with_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(5, "b"), (5, "a"), (None, "c"), (5, "b"), (-1, None)], "doc_id bigint, text string")
    path = scratch_path(spark, "planes-test")
    plane_files.write(docs, path, JSON)
    got = plane_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -1, 5, 5, 5] and [r.start for r in got] == [0, 2, 3, 5, 7]


def test_bpe_is_that_of_the_library():
    ranks, want = byte_bpe.Ranks(open(RANKS, "rb").read()), reference()
    texts = [t or "" for t in TEXTS] + random_texts(3000)
    for text, got in zip(texts, ranks.encode(texts), strict=True):
        assert got.ids.tolist() == want.encode_ordinary(text), text
        assert ranks.decode(got.ids) == text.encode()
        assert ranks.decimals(got.ids).decode() == ",".join(map(str, got.ids.tolist()))
        raw = text.encode()
        cuts = [*got.offsets.tolist(), len(raw)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            assert ranks.decode(got.ids_between(a, b)) == raw[a:b]


@pytest.mark.parametrize("stretch", [1, 2, 7, 64])
def test_piece_starts_do_not_depend_on_the_stretch(stretch):
    pattern = __import__("regex").compile(public_tokenizers.PATTERN)
    for text in random_texts(200, 11):
        if not text:
            continue
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        first = np.zeros(len(points), dtype=bool)
        first[0] = True
        marks = byte_bpe.piece_starts(points, first, stretch)
        assert np.flatnonzero(marks).tolist() == [m.start() for m in pattern.finditer(text)]


def test_bpe_frames(spark):
    docs = rows(spark, TEXTS)
    want = reference()
    digests = {r.doc_id: r for r in byte_bpe.round_trip_digests(docs, RANKS).collect()}
    encoded = byte_bpe.encode(docs, RANKS)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    back = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(encoded, RANKS).collect()}
    for i, text in enumerate(TEXTS):
        text = text or ""
        expected = want.encode_ordinary(text)
        assert ids[i] == expected and back[i] == text.encode()
        assert digests[i].n_tokens == len(expected)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark):
    docs = rows(spark, TEXTS).limit(0)
    assert token_counts.token_counts(docs, JSON).count() == 0
    assert byte_bpe.round_trip_digests(docs, RANKS).count() == 0
    path = scratch_path(spark, "planes-test")
    plane_files.write(docs, path, JSON)
    assert plane_files.read(spark, path).count() == 0
