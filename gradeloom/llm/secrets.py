"""Secret scan with false-positive removal by a random forest, in column expressions and Spark's own learner only.

Candidates are runs of code-like characters that hold a digit, and whatever is assigned to a secret's name, with or without
a digit and of any characters. Each is described by its length, the changes between its character classes, the part of it
that words of the corpus cover, path-like marks, and the words around it. A forest trained on labelled findings scores all
of them. Findings can be labelled by people; ``rule_labels`` labels those whose surroundings or full form leave no doubt (an
assignment to a secret's name, the form of a key; an address, a number), the forest judges the rest. Half of the secrets it
learns from are shown without the name and the assignment, so that it has to look at the candidate itself.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.plans.once import fresh
from gradeloom.plans.skew import lookup_join, materialize
from gradeloom.session import scratch_path

_CODE = r"A-Za-z0-9_+/.@\-"
#: At least ten code-like characters, starting where a run starts, with a digit, and the padding of an encoding.
CODE_RUN = rf"(?<![{_CODE}])(?=[{_CODE}]*[0-9])[{_CODE}]{{10,}}+={{0,2}}"
# Names that secrets are given, and parts of paths that hold examples.
NAMES = "token|secret|passwd|password|pwd|api_?key|access_?key|private_?key|auth|credential|bearer"
EXAMPLE_PATHS = "test|example|sample|fixture|mock|doc"
# The sign of an assignment, with the name's closing quote; what stands behind a value may be looked back on only so far.
_SIGN = r"[\"']?\s{0,16}[:=]{1,2}>?\s{0,16}"
# The near sign is looked for first: few places have one.
_GIVEN = rf"(?<=[:=>\s\"'])(?<=[:=]>?\s{{0,16}}[\"']?)"
#: What is assigned to a name of ``NAMES``, from four characters on: to the closing quote on its line, or else up to white
#: space, without the quotes, brackets and stops that close the phrase around it.
ASSIGNED = rf"{_GIVEN}(?:" + "|".join((
    rf"(?<=(?i:{NAMES}){_SIGN}\")[^\"\r\n]{{4,}}+(?=\")",
    rf"(?<=(?i:{NAMES}){_SIGN}')[^'\r\n]{{4,}}+(?=')",
    rf"(?<=(?i:{NAMES}){_SIGN}[\"']?)[^\s\"'=:>]\S{{2,}}[^\s\"',;.)\]}}>]",
)) + ")"
CANDIDATE = f"{ASSIGNED}|{CODE_RUN}"
BEFORE_CHARS, AFTER_CHARS = 64, 32
# Forms of keys that services give out.
KEY_FORM = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^glpat-[0-9A-Za-z_\-]{20,}$|^xox[abprs]-[0-9A-Za-z\-]{10,}$"
    r"|^[rs]k_(live|test)_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_\-]{35}$|^eyJ[0-9A-Za-z_\-]{8,}\.eyJ[0-9A-Za-z_\-]{8,}\.[0-9A-Za-z_\-]*$"
)
#: Words from this number of occurrences in the corpus on are in its dictionary.
WORD_COUNT = 20
WORD = "[a-z]{3,}"
#: Labelled findings used for training at most, half of them of each kind, those with the lowest hashes.
SAMPLE_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 6, 37
MARK = "[SECRET]"

FEATURES = (
    "length", "transitions", "transition_share", "digit_share", "upper_share", "lower_share", "mark_share", "distinct_share",
    "coverage", "slashes", "dots", "ats", "in_examples", "assigned", "quoted", "named", "words_before",
)


def _start_sql() -> str:
    """SQL for the start of match ``i``: the sum of ``sizes`` before it, by whole stretches of 256 and the rest."""
    whole = "aggregate(slice(stretches, 1, i div 256), 0L, (s, x) -> s + x)"
    rest = "aggregate(slice(sizes, (i div 256) * 256 + 1, i % 256), 0L, (s, x) -> s + x)"
    return f"{whole} + {rest} + length(gaps[i])"


def findings(docs: DataFrame, text: str = "text", doc: str = "doc_id", path: str | None = None) -> DataFrame:
    """``doc_id, text_key, start, candidate, before, after, path``: every candidate of every whole text.

    ``start`` counts characters from 0. A null or empty text has none.
    """
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), where.alias("path"))
    # Any candidate has a digit or the sign of an assignment, which is looked for first: that is far cheaper.
    rows = rows.filter(F.col("text").rlike("[0-9:=]") & F.col("text").rlike(CANDIDATE))
    rows = rows.select("doc_id", "path", F.xxhash64("text").alias("text_key"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    rows = rows.withColumn("sizes", F.expr("transform(found, (m, i) -> CAST(length(m) + length(gaps[i]) AS BIGINT))"))
    rows = rows.withColumn("stretches", F.expr("transform(sequence(0, size(sizes) div 256), k -> aggregate(slice(sizes, k * 256 + 1, 256), 0L, (s, x) -> s + x))"))
    each = f"transform(found, (m, i) -> named_struct('start', {_start_sql()}, 'candidate', m, 'before', right(gaps[i], {BEFORE_CHARS}), 'after', left(gaps[i + 1], {AFTER_CHARS})))"
    return rows.select("doc_id", "text_key", "path", F.expr(f"inline({each})")).select("doc_id", "text_key", "start", "candidate", "before", "after", "path")


def rule_labels(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for what is assigned to a secret's name and looks drawn at random or mixes three kinds of characters, and
    for what has the form of a key (``KEY_FORM``) or is the password of a web address, wherever it stands; 0 for addresses, numbers, what only stands for a value, and digests, identifiers and paths that nothing near them names or
    assigns; else null."""
    c = F.col("candidate")
    given = F.col("before").rlike(rf"(?i)({NAMES})[\"']?\s*[=:]{{1,2}}>?\s*[\"']?$")
    random = c.rlike(r"^[A-Za-z0-9+/_=\-]{16,}$") & c.rlike("[A-Za-z]") & c.rlike("[0-9]")
    kinds = sum((c.rlike(k).cast("int") for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]")), F.lit(0))
    mixed = c.rlike(r"^[!-~]{8,}$") & (kinds >= 3)
    number = c.rlike(r"^[0-9./_+\-]+$")
    address = c.rlike(r"^[A-Za-z0-9_.+\-]+@[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)+\.?$") | c.rlike("^//")
    stand_in = c.rlike(r"^([$%]?[{(]|<)") | c.rlike(r"^(?i)(none|null|nil|true|false|str|string|required|optional|x{4,}|\*{4,})$")
    free = ~F.col("before").rlike(rf"(?i)({NAMES})\W{{0,12}}$") & ~F.col("before").rlike(r"[=:]>?\s*[\"']?$")
    digest = c.rlike(r"^(?i)([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})$")
    identifier = c.rlike(r"^[A-Za-z]+([_.\-][A-Za-z]+)*[_.\-]?[0-9]{1,4}$")
    web_or_path = c.rlike(r"^[A-Za-z0-9_.\-]*[./][A-Za-z0-9_.\-]*[A-Za-z]{2,}[A-Za-z0-9_.\-]*/[A-Za-z0-9_./\-]*$")
    common = free & (digest | identifier | web_or_path)
    in_address = F.col("before").rlike(r"://[^\s/:@]{1,64}:$") & c.contains("@")
    secret = (given & ~stand_in & (random | (mixed & ~address))) | c.rlike(KEY_FORM) | in_address
    return found.withColumn("label", F.when(secret, 1).when(number | address | stand_in | common, 0).cast("int"))


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``run, n``: letter runs that occur ``WORD_COUNT`` times or more in all texts."""
    runs = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text).cast("string")), F.lit(WORD), F.lit(0))).alias("run"))
    return runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= WORD_COUNT)


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``candidate, covered``: how many characters of each distinct candidate are dictionary words."""
    runs = found.select("candidate").distinct()
    runs = runs.select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(WORD), F.lit(0))).alias("run"))
    known = words.join(runs.select("run").distinct(), "run", "left_semi").select("run")
    hits = lookup_join(runs, known, ["run"], ["candidate"], label="known-runs")
    return hits.groupBy("candidate").agg(F.sum(F.length("run")).alias("covered"))


def _share(of: str) -> Column:
    return F.length(F.regexp_replace("candidate", f"[^{of}]", "")) / F.length("candidate")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the features."""
    c, before = F.col("candidate"), F.col("before")
    size = F.length("candidate")
    changes = F.regexp_count(c, F.lit("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"))
    rows = lookup_join(found, coverage(found, words), ["candidate"], ["doc_id", "start"], "left", "coverage")
    features = {
        "length": size, "transitions": changes, "transition_share": changes / size, "digit_share": _share("0-9"),
        "upper_share": _share("A-Z"), "lower_share": _share("a-z"), "mark_share": _share(r"_+/=.@\-"),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / size, "coverage": F.coalesce("covered", F.lit(0)) / size,
        "slashes": F.regexp_count(c, F.lit("/")), "dots": F.regexp_count(c, F.lit("[.]")), "ats": F.regexp_count(c, F.lit("@")),
        "in_examples": F.coalesce(F.col("path").rlike(f"(?i)(^|[^a-z])({EXAMPLE_PATHS})"), F.lit(False)),
        "assigned": before.rlike(r"[=:]>?\s*[\"']?$"), "quoted": before.rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "named": before.rlike(rf"(?i)({NAMES})\W{{0,12}}$"), "words_before": F.regexp_count(before, F.lit(r"\p{L}+")),
    }
    return rows.withColumns({f"f_{k}": v.cast("double") for k, v in features.items()}).drop("covered")


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", doc: str = "doc_id", path: str | None = None) -> DataFrame:
    """``doc_id, text_key, start, length, candidate, label, score, is_secret``: every candidate with the forest's probability.

    ``labelled (doc_id, start, label)`` are findings judged before; without it ``rule_labels`` gives the labels. Training uses
    at most ``SAMPLE_FINDINGS`` of them, half of each kind. A labelled finding keeps its label, whatever its score. If they are not of both kinds there is nothing to learn: labels are the scores,
    and what has none is kept as no secret.

    A null or empty text has no candidates; a null ``doc_id`` is kept; equal rows have equal findings, each its own. An empty
    table gives an empty result; other columns are not read.
    """
    found = materialize(findings(docs, text, doc, path), "findings")
    words = dictionary(docs, text)
    rows = described(found, words)
    if labelled is None:
        rows = rule_labels(rows)
    else:
        given = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("start").cast("bigint").alias("start"), F.col("label").cast("int").alias("label"))
        rows = rows.join(given.groupBy("doc_id", "start").agg(F.min("label").alias("label")), ["doc_id", "start"], "left")
    rows = materialize(rows, "described")
    known = rows.filter("label IS NOT NULL")
    # Of each kind by itself, so that a rare kind is not missed.
    by_hash = [F.xxhash64("doc_id", "start", "candidate"), "doc_id", "start"]
    halves = [known.filter(F.col("label") == kind).orderBy(*by_hash).limit(SAMPLE_FINDINGS // 2) for kind in (0, 1)]
    sample = halves[0].unionByName(halves[1])
    if labelled is None:
        sample = _without_names(sample)
    sample = materialize(sample.select("label", *[f"f_{k}" for k in FEATURES]), "labelled")
    kinds = {r.label for r in sample.select("label").distinct().collect()}
    kept = ["doc_id", "text_key", "start", F.length("candidate").alias("length"), "candidate", "label"]
    if kinds != {0, 1}:
        score = F.coalesce(F.col("label").cast("double"), F.lit(0.0))
        return rows.select(*kept, score.alias("score"), (score >= 0.5).alias("is_secret"))
    vector = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    # Stored and read again: a fitted model refers to the session, and could not be sent to tasks.
    path = scratch_path(docs.sparkSession, "forest")
    forest.fit(vector.transform(sample)).save(path)
    model = RandomForestClassificationModel.load(path)
    scored = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    # What was judged, by people or by a rule that leaves no doubt, stays as it was judged.
    return scored.select(*kept, "score", F.coalesce(F.col("label") == 1, F.col("score") >= 0.5).alias("is_secret"))


def _without_names(sample: DataFrame) -> DataFrame:
    """Half of the secrets of :func:`rule_labels` without the name and the assignment by which the rules knew them.

    Else the forest would only learn these rules again. Bare digests keep theirs: without a name they are no secrets.
    """
    digest = F.col("candidate").rlike("^(?i)[0-9a-f]+$")
    masked = (F.col("label") == 1) & ~digest & (F.pmod(F.xxhash64("candidate", F.lit(SEED)), F.lit(2)) == 0)
    return sample.withColumns({f"f_{k}": F.when(masked, 0.0).otherwise(F.col(f"f_{k}")) for k in ("named", "assigned", "quoted")})


def redact(docs: DataFrame, scanned: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``MARK``; other columns, whatever their names, and rows as they are."""
    # Working columns have names that no column of the documents has.
    of_doc, of_text, spans = fresh(docs.columns, "of_doc", "of_text", "spans")
    no_id = F.lit(-1).cast("bigint")
    secret = scanned.filter("is_secret").select(F.coalesce("doc_id", no_id).alias(of_doc), F.col("text_key").alias(of_text), "start", "length")
    found = secret.groupBy(of_doc, of_text).agg(F.reverse(F.array_sort(F.collect_set(F.struct("start", "length")))).alias(spans))
    whole = F.col(f"`{text}`")
    rows = docs.withColumns({of_doc: F.coalesce(F.col(f"`{doc}`").cast("bigint"), no_id), of_text: F.xxhash64(whole.cast("string"))})
    rows = lookup_join(rows, found, [of_doc, of_text], [of_text], "left", "spans")
    put = lambda t, s: F.overlay(t, F.lit(MARK), (s["start"] + 1).cast("int"), s["length"].cast("int"))
    clean = F.when(F.col(spans).isNull(), whole).otherwise(F.aggregate(spans, whole, put))
    return rows.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
