import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gradeloom.llm import spelling

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def counted(data, drop_every):
    out = Counter()
    for doc, text, *_ in data:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def near_pairs(words):
    return {(a, b) for a in words for b in words if one_edit(a, b)}


def brute_force(words):
    near = defaultdict(list)
    for a, b in near_pairs(words):
        near[a].append(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def word_set(seed, n, letters, sizes):
    rnd = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rnd.choice(letters) for _ in range(rnd.choice(sizes)))
        words.add(w)
        at = rnd.randrange(len(w))
        words.add(rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1 :]]))
    return {w: rnd.choice([5, 6, 25, 30, 150, 751]) for w in words}


@pytest.mark.parametrize(
    ("letters", "sizes", "most"),
    [("ab", (6, 7, 8), 5), ("abcé", (6, 9), 3), ("abcdefghij", (6, 7, 8, 9), 40), ("aé", (64, 65, 66), 512), ("abc", (70, 71), 2), ("a", (6, 7, 8, 64, 65, 66, 90, 91), 1)],
)
def test_near_words_equal_brute_force(spark, monkeypatch, letters, sizes, most):
    monkeypatch.setattr(spelling, "LIST_MOST", most)
    words = word_set(7, 8 if letters == "a" else 250, letters, sizes) if letters != "a" else {"a" * s: 5 + s for s in sizes}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = spelling.near_words(table).collect()
    assert len(got) == len(set(got)) and {(r.word, r.near) for r in got} == near_pairs(words)
    assert all(r.n == words[r.word] and r.near_n == words[r.near] for r in got)


def test_most_words_go_by_their_grams():
    words = word_set(3, 400, "abcdefghij", (8, 9, 10))
    grams = Counter(m[i : i + k] for w in words for m in [spelling.START + w + spelling.END] for k in range(2, 7) for i in range(len(m) - k + 1))
    frequent = frozenset(g for g, n in grams.items() if n > 20)
    bounds = [spelling.gram_bound(spelling.grams_of(w, frequent)) for w in words]
    assert sum(b >= 1 for b in bounds) > 0.9 * len(bounds)


@pytest.mark.parametrize("seed", range(3))
def test_the_bound_holds_for_every_edit(seed):
    words = list(word_set(seed, 60, "abc", (6, 7, 9)))
    frequent = frozenset(["ab", "bc", "aba", "\x01a", "c\x02", "ca"])
    for w in words:
        spans, marked = spelling.grams_of(w, frequent), spelling.START + w + spelling.END
        bound = spelling.gram_bound(spans)
        for at in range(len(w) + 1):
            for other in {w[:at] + w[at + 1 :], *(w[:at] + x + w[at:] for x in "abc"), *(w[:at] + x + w[at + 1 :] for x in "abc")}:
                if not one_edit(w, other):
                    continue
                far = spelling.START + other + spelling.END
                mine = {(a, marked[a:b]) for a, b in spans} , {(len(marked) - a, marked[a:b]) for a, b in spans}
                others = spelling.grams_of(other, frequent)
                shared = mine[0] & {(a, far[a:b]) for a, b in others} , mine[1] & {(len(far) - a, far[a:b]) for a, b in others}
                kept = {(a, marked[a:b]) for a, b in spans if (a, marked[a:b]) in shared[0] or (len(marked) - a, marked[a:b]) in shared[1]}
                assert len(kept) >= bound


def corpus(seed, n):
    rnd = random.Random(seed)
    words = list(word_set(seed, 80, "abcdé", (6, 7, 8)))
    weights = [rnd.choice([1, 1, 5, 40]) for _ in words]
    data = []
    for i in range(n):
        text = rnd.choice([" ", ", ", "1", "Ā"]).join(w.upper() if rnd.random() < 0.1 else w for w in rnd.choices(words, weights, k=rnd.randint(0, 60)))
        data.append((i, text, "clash", 5))
    return data + [(None, "ÀBCDEF " * 6, None, None), (3, data[3][1], "again", 1), (3, None, "x", 1), (n, "", "x", 1), (n + 1, "Éclair×éclair÷éclairs", "x", 2)]


@pytest.mark.parametrize(("seed", "n", "drop_every"), [(1, 0, None), (2, 150, 7), (3, 300, None)])
def test_variants_equal_brute_force(spark, seed, n, drop_every):
    data = corpus(seed, max(n, 4))
    docs = spark.createDataFrame(data, "doc_id bigint, text string, word string, n int")
    want = brute_force(counted(data, drop_every))
    for source in (docs, docs.repartition(5)):
        rows = spelling.variants(source, drop_every=drop_every).collect()
        assert len(rows) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == want
    assert not n or any(v[0] for v in want.values())


def test_chains_end_at_their_root(spark):
    data = [(f"chain{i}", f"chain{i + 1}") for i in range(20)] + [("side", "chain7")]
    rows = spelling.roots_of(spark.createDataFrame(data, "word string, form string")).collect()
    assert len(rows) == 21 and {r.root for r in rows} == {"chain20"}


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a few shor words")], "doc_id bigint, text string")
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.limit(0)).count() == 0


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "STRETCH_BYTES", 100)
    text = " ".join(f"Wörter{'x' * (i % 30)}" for i in range(400)) + "é" * 300 + "."
    got = Counter()
    for run, n in spelling.runs_of(5, text.encode(), 11):
        got[run] += n
    want = Counter()
    for run in RUN.findall(text.translate(LOWER)):
        h = zlib.crc32(f"5:{run}".encode())
        want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 11 == 0 else run] += 1
    assert got == want


def test_counts_and_lists_are_combined_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    text = spelling.word_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.index("partial_sum")
