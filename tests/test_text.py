import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from gradeloom.functions import text as t
from gradeloom.functions.metrics import char_ratio, metric, register_metric, similarity


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, fn, kind="string"):
    return [r.y for r in column(spark, values, kind).select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip_matches_python(spark):
    values = [c + "a b" + c for c in map(chr, range(1, 0x3100)) if not 0xD800 <= ord(c) < 0xE000]
    assert apply(spark, values, t.py_strip) == [v.strip() for v in values]


def test_strip_fences(spark):
    cases = {
        "```go\nfunc a()\n```": "func a()",
        "```\nx\n```": "x",
        "plain": "plain",
        "```json\nonly open": "only open",
        "```": "",
        "a ```b``` c": "a ```b``` c",
        "  ```é9_\n x \n``` \n": "x",
        "x```": "x",
        "": "",
    }
    assert apply(spark, list(cases), t.strip_fences) == list(cases.values())


def test_exact_round_matches_python(spark):
    rng = random.Random(5)
    values = [rng.random() * 3 for _ in range(5000)] + [i / 160 for i in range(2000)] + [i / 20000 for i in range(20000)]
    values += [2.675, 1.005, 0.12345, 0.0005, 5e-05, -0.12345, 123456.78905]
    for digits in (1, 2, 3, 4):
        got = apply(spark, values, lambda c: t.exact_round(c, digits), "double")
        assert got == [round(v, digits) for v in values]


def test_band_edges(spark):
    assert apply(spark, [0.8, 0.79996, 0.6, 0.4, 0.39999, 0.0, None], t.band, "double") == [
        "EXCELLENT", "GOOD", "GOOD", "PARTIAL", "POOR", "POOR", None
    ]
    assert apply(spark, [0.79996], t.stored_score, "double") == [0.8]


def ratios(spark, pairs, **options):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    return [r.y for r in df.select("i", char_ratio(F.col("a"), F.col("b"), **options).alias("y")).orderBy("i").collect()]


def difflib(a, b, autojunk=True):
    return SequenceMatcher(None, a.strip(), b.strip(), autojunk).ratio()


def text_pairs():
    rng = random.Random(11)
    pairs = [("", ""), ("tide", "diet"), ("diet", "tide"), (" a ", "a"), ("", "x"), ("ab" * 150, "ab" * 150), ("ab" * 150, "ab" * 120)]
    for _ in range(150):
        alphabet = rng.choice(["ab", "abc \n", "abcdefghijklmnop é"])
        a = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 400)))
        b = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 400)))
        cut = rng.randrange(0, len(a) + 1)
        pairs += [(a, b), (a, a[:cut]), (a[:cut], a), (a, a), (a, a[:cut] + "#" + b)]
    return pairs


def test_char_ratio_matches_difflib(spark):
    pairs = text_pairs()
    assert ratios(spark, pairs) == [difflib(a, b) for a, b in pairs]
    assert ratios(spark, pairs, autojunk=False) == [difflib(a, b, False) for a, b in pairs]


def test_char_ratio_same_on_one_and_many_partitions(spark):
    pairs = [(i, a, b) for i, (a, b) in enumerate(text_pairs())]
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    out = [
        df.repartition(n).select("i", similarity(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect() for n in (1, 8)
    ]
    assert out[0] == out[1]


def test_metric_registry(spark):
    register_metric("same", lambda a, b: (a == b).cast("double"))
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "a string, b string")
    assert [r.s for r in df.select(metric("same")(F.col("a"), F.col("b")).alias("s")).collect()] == [1.0, 0.0]
    assert metric("char_ratio") is char_ratio


def test_length_ratio(spark):
    df = spark.createDataFrame([("```go\nabcd\n```", "ab"), ("x", ""), ("", "abc"), ("aa", "aaa")], "g string, e string")
    assert [r.y for r in df.select(t.length_ratio(F.col("g"), F.col("e")).alias("y")).collect()] == [2.0, 1.0, 0.0, 0.67]


def test_format_flags(spark):
    cases = {
        "func a()": (True, False),
        "package x\nfunc a()": (False, True),
        "func a()\nimport x": (True, False),
        "// c\r\n import(\n": (False, True),
        "  imports": (False, False),
        "```go\nfunc a()\n```": (True, False),
        "importance\nfunc": (False, False),
        "": (False, False),
    }
    got = apply(spark, list(cases), t.format_flags)
    assert [(g.func_start, g.boilerplate) for g in got] == list(cases.values())


def test_score_bar_and_trend(spark):
    assert apply(spark, [0.5], lambda c: t.score_bar(c, 4), "double") == ["[██··] 0.50"]
    assert apply(spark, [0.1, -0.1, 0.0], t.trend, "double") == ["▲", "▼", "─"]
    assert apply(spark, [0.004, -0.1], lambda c: t.trend(c, 0.005), "double") == ["→", "▼"]
