import random
import re

import numpy as np
import pytest

import corpus_pipeline
from gradeloom.llm import minhash, shingles
from gradeloom.llm.components import connected_components

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def shingle_set(text, width):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(text or "")]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def corpus(seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 120))) for _ in range(40)]
    for base in texts[:12]:
        for _ in range(6):  # near copies at all distances
            own = base.split()
            for _ in range(rnd.randint(0, 6)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            texts.append(" ".join(own))
    texts += [texts[0], texts[0].upper(), texts[1] + "\n", None, "", " \t", "one", "ONE", "two words", "Été", "été", "a b c d a b c d a b c d"]
    texts.append("long " * 30_000)
    return texts


def brute(texts, width, percent):
    sets = [shingle_set(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("width", [4, 5])
def test_sets_are_those_of_words(width):
    texts = corpus()
    hashes, sizes = shingles.shingle_sets([(t or "").encode() for t in texts], width)
    assert sizes.tolist() == [len(shingle_set(t, width)) for t in texts]
    parts = np.split(hashes, np.cumsum(sizes)[:-1])
    for a in range(0, len(texts), 5):
        for b in range(0, len(texts), 3):
            want = len(shingle_set(texts[a], width) & shingle_set(texts[b], width))
            assert len(np.intersect1d(parts[a], parts[b])) == want


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUBS", 1)  # so that the comparison across components has work
    monkeypatch.setattr(minhash, "HUB_TURNS", 2)
    monkeypatch.setattr(minhash, "CROSS_PER_ROW", 1)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id bigint, text string, bands string, n_shingles int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 4, 80).collect()}
    assert got == {i: (n, root, root == i) for i, (n, root) in enumerate(brute(texts, 4, 80))}
    assert minhash.near_duplicates(docs.limit(0), 4, 80).count() == 0


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (7, "a b c d e")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (3, 3, True), (3, 3, True), (7, 3, False)]


def test_one_id_on_several_texts(spark):
    text = lambda k, n=30: " ".join(f"{k}{i}" for i in range(n))
    # 5 stands for a text of its own and for a copy of 2's; 9 twice for near copies of one text; 4 wholly repeats.
    data = [(5, text("a")), (5, text("b")), (2, text("b")), (9, text("c")), (9, text("c") + " end"), (4, text("d")), (4, text("d")), (None, text("a")), (1, None), (1, "")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    want = [(None, None, True)] + [(1, 1, True)] * 2 + [(2, 2, True), (4, 4, True), (4, 4, True), (5, 2, False), (5, 5, True), (9, 9, False), (9, 9, True)]
    for source in (docs, docs.repartition(7)):
        rows = minhash.near_duplicates(source).collect()
        got = sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=lambda r: (r[0] or 0, r[1] or 0, r[2]))
        assert got == want and len({(r.doc_id, r.text_key, r.kept) for r in rows}) == 8


def test_pipeline_drops_rows_not_ids(spark):
    text = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    data = [(5, text("a"), "x", 1), (5, text("b"), "x", 1), (2, text("b"), "x", 1), (4, text("d"), "x", 1), (4, text("d"), "x", 1), (None, text("e"), "x", 1)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, text_key string, gone_id int")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text[0]) for r in out.collect()) == [(0, "e"), (2, "b"), (4, "d"), (5, "a")]


def test_estimate_is_near_the_similarity():
    rnd = random.Random(5)
    own = [f"v{i}" for i in range(600)]
    other = [w if rnd.random() > 0.03 else f"u{i}" for i, w in enumerate(own)]
    texts = [" ".join(own), " ".join(other)]
    a, b = (shingle_set(t, 4) for t in texts)
    true = len(a & b) / len(a | b)
    *_, packed, bands = minhash.signatures([t.encode() for t in texts], 4)
    differ = packed[0] ^ packed[1]
    lanes = np.uint64(0x5555555555555555)
    unequal = sum(int(x).bit_count() for x in ((differ | differ >> np.uint64(1)) & lanes))
    agree = 1 - unequal / 256
    assert abs((agree - 0.25) / 0.75 - true) < 0.15 and bands.shape == (2, 32)


def test_components(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rnd.randrange(30), 100 + rnd.randrange(30)) for _ in range(20)] + [(200, 200), (300, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {n: n for e in edges for n in e if n is not None}
    for _ in range(80):
        for a, b in edges:
            if b is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert got == {n: c for n, c in root.items() if n not in (200, 300) and any(n in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
