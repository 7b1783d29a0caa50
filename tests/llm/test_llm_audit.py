import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import filter_audit

SCHEMA = "doc_id bigint, text string, source string, part string, mask int, digest string"
WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def fails_of(data):
    least = {}
    for doc, text, *_ in data:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out = []
    for doc, text, source, *_ in data:
        t = text or ""
        words = WORDS.findall(t)
        flags = (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(re.search("[#$%&*|]", t)), doc is not None and doc > least[t],
        )
        out.append((source or "", doc, {c for c, f in zip("ABCDE", flags, strict=True) if f}))
    return out


def brute_force(data, good, toxic):
    """Every order, document by document."""
    out = {}
    shapley = defaultdict(int)
    rows = fails_of(data)
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[2]]
                left = [r for r in left if name not in r[2]]
                failing = sum(name in r[2] for r in mine)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(r[2] == {name} for r in mine),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone),
                ]
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def corpus(n, seed):
    rnd = random.Random(seed)
    texts = [None, "", "A", "# x", "w " * 60] + [
        " ".join(rnd.choice(["a", "b", "Cé", "DD", "e#", *[f"w{j}" for j in range(40)]]) for _ in range(rnd.choice([5, 49, 50, 80]))) for _ in range(n // 2)
    ]
    data = [(i, rnd.choice(texts), rnd.choice(["s", "t", None, ""]), "clash", 9, "clash") for i in range(n)]
    # A repeated id with another text and with the same one, whole repeats, and rows without id.
    return data + [(3, "A", "s", "x", 1, "y"), (3, "A", "t", "x", 1, "y"), *(data[5:6] * 2), (None, "A", "s", None, None, None), (None, None, None, None, None, None)]


@pytest.mark.parametrize(("n", "seed"), [(0, 1), (60, 2), (300, 3)])
def test_audit_equals_brute_force(spark, n, seed):
    data = corpus(n, seed)
    rnd = random.Random(seed)
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, n, 2)] + [(4, 1, None), (4, 0, 1), (None, 1, 1)]
    good, toxic = ({r[0] for r in labels if r[k] == 1 and r[0] is not None} for k in (1, 2))
    docs = spark.createDataFrame(data, SCHEMA)
    out = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    rows = out.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.REPORT) for r in rows}
    assert len(got) == len(rows) and got == brute_force(data, good, toxic)
    again = filter_audit.audit(docs.repartition(5), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_no_documents(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_walk_gives_every_subset():
    rng = np.random.default_rng(1)
    for filters in (1, 3, 5):
        cells = rng.integers(0, 9, size=(1 << filters, 2))
        states = filter_audit.subset_states(cells)
        for active in range(1 << filters):
            want = sum((cells[m] for m in range(1 << filters) if not m & active), np.zeros(2, dtype=int))
            assert (states[active] == want).all()


@pytest.mark.parametrize("set_bytes", [1 << 18, 1 << 23])
def test_words_of_long_texts_are_counted_whole(set_bytes):
    text = b" ".join(b"w%d" % (i * i % 70_001) for i in range(600_000))
    words = text.split()
    assert filter_audit.word_numbers(text, set_bytes) == (len(words), len(set(words)))
    assert filter_audit.word_numbers(b"x" * 3_000_000, set_bytes) == (1, 1)


def test_a_common_text_in_many_parts(spark):
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.concat(F.lit("s"), F.col("id") % 50).alias("source"))
    labels = spark.createDataFrame([(0, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = filter_audit.audit(docs, labels).filter("filter_order = 'EABCD' AND step = 1").collect()
    assert len(rows) == 50 and sum(r.kept for r in rows) == 1 and sum(r.removed for r in rows) == 1_999
