"""Spelling variants grouped with a variable-length gram index.

1. Words and their numbers of occurrences are counted over all documents.
2. The gram dictionary holds the frequent grams of ``SHORTEST`` to ``LONGEST`` characters, pruned by frequency: a gram is
   extended only while it is frequent, so the first rare extension ends it. Its size has a fixed bound.
3. A word is decomposed into variable-length grams: at each place the shortest one that is not frequent. A gram is found
   from its own characters alone, so an edit affects just the grams whose characters it touches.
4. Bound per word: an edit leaves ``grams - affected`` of its grams untouched, ``affected`` being the most that one place
   lies in. Where that is at least one, the gram that ends first and the gram that starts last are apart, and no edit touches
   both. The first depends on the characters up to its end alone and the last on those from its start, so a near word has
   the same first gram at the same distance from its start, or the same last gram at the same distance from its end.
   The word's two lists are merged and their words verified by edit distance.
5. Words whose bound is zero (short ones, or made of frequent grams), and words with a list above ``LIST_MOST``, are found
   exactly by the words that one deletion leads to, or by halves if they are long. No list is read beyond its bound.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gradeloom.llm import batches
from gradeloom.plans.skew import join_measured, lookup_join, materialize, materialize_measured

#: Lengths of grams, words at most in a list that is merged, and grams at most in the dictionary.
SHORTEST, LONGEST = 2, 6
LIST_MOST, DICTIONARY_MOST = 512, 200_000
#: Longest word that is looked up by its deletions.
LONG_WORD = 64
#: Bytes of a slice of documents and of a stretch of a long text; entries a worker counts before it passes them on.
BATCH_BYTES, STRETCH_BYTES, HELD_ENTRIES = 1 << 22, 1 << 20, 200_000
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
RUN = re.compile("[a-zÀ-ÿ]+")
BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
#: Marks of a word's start and end; they are no letters.
START, END = "\x01", "\x02"


def _stretches(text: bytes) -> Iterator[bytes]:
    """A text cut where no run of letters can go on."""
    at = 0
    while len(text) - at > STRETCH_BYTES:
        gap = BREAK.search(text, at + STRETCH_BYTES)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def runs_of(doc: object, text: bytes, drop_every: int | None) -> Iterator[tuple[str, int]]:
    """Lower-cased runs of letters of a text with their numbers, a stretch at a time.

    With ``drop_every``, a run whose checksum (with the document's id) it divides loses one code point.
    """
    seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
    for stretch in _stretches(text):
        for run, n in Counter(RUN.findall(stretch.translate(LOWER).decode())).items():
            if drop_every:
                h = zlib.crc32(run.encode(), seed)
                if h % drop_every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            yield run, n


def _sums(pairs: Iterable[tuple[str, int]], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Numbers added up per text, passed on whenever many texts are held."""
    held: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names)

    for text, n in pairs:
        held[text] += n
        if len(held) >= HELD_ENTRIES:
            yield batch()
            held.clear()
    if held:
        yield batch()


def word_counts(
    docs: DataFrame,
    least_chars: int = 6,
    least_count: int = 5,
    drop_every: int | None = None,
    text: str = "text",
    doc: str = "doc_id",
) -> DataFrame:
    """``word, n`` of the words of all documents with at least so many code points and occurrences.

    Words are maximal runs of ``A-Za-z`` and U+00C0 to U+00FF, ``A-Z`` lower-cased. A null text has none; a null id counts as
    an empty one. Other columns are not read.
    """

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[str, int]]:
            for part in batches.by_bytes(parts, "text", BATCH_BYTES):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for doc_id, content in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    for word, n in runs_of(doc_id, content or b"", drop_every):
                        if len(word) >= least_chars:
                            yield word, n

        return _sums(pairs(), ("word", "n"))

    narrow = docs.select(F.col(doc).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = narrow.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, above: int, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """``gram, n``: grams of the marked words that occur more than ``above`` times; a frequent gram's beginnings are too."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[str, int]]:
            for part in parts:
                for word in part.column("word").to_pylist():
                    marked = START + word + END
                    for size in range(shortest, longest + 1):
                        for at in range(len(marked) - size + 1):
                            yield marked[at : at + size], 1

        return _sums(pairs(), ("gram", "n"))

    counted = words.select("word").mapInArrow(run, "gram string, n bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > above)


def grams_of(word: str, frequent: frozenset[str], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int]]:
    """Spans of a marked word's grams: at each place the shortest one that is not frequent, if there is one."""
    marked = START + word + END
    spans = []
    for at in range(len(marked) - shortest + 1):
        for end in range(at + shortest, min(at + longest, len(marked)) + 1):
            if marked[at:end] not in frequent:
                spans.append((at, end))
                break
    return spans


def gram_bound(spans: list[tuple[int, int]]) -> int:
    """How many of the grams any single edit leaves untouched.

    An edit changes a character or the gap between two; a gram is touched if that lies inside it.
    """
    if not spans:
        return 0
    changes = Counter()
    for a, b in spans:
        changes[a] += 1
        changes[b] -= 1
    affected = most = 0
    for place in sorted(changes):
        affected += changes[place]
        most = max(most, affected)
    return len(spans) - most


def word_lists(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """``word, n, chars, bound, first_gram, last_gram``: the bound of each word, and the keys of its two lists."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in parts:
            bounds, firsts, lasts = [], [], []
            texts = part.column("word").to_pylist()
            for word in texts:
                spans, marked = grams_of(word, known), START + word + END
                bounds.append(gram_bound(spans))
                if spans:
                    (a, b), (c, d) = min(spans, key=lambda s: (s[1], s[0])), spans[-1]
                    firsts.append(f"{a}>{marked[a:b]}")
                    lasts.append(f"{len(marked) - c}<{marked[c:d]}")
                else:
                    firsts.append(None)
                    lasts.append(None)
            chars = [len(w) for w in texts]
            columns = [pa.array(chars, pa.int32()), pa.array(bounds, pa.int32()), pa.array(firsts, pa.string()), pa.array(lasts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [part.column("word"), part.column("n"), *columns], ["word", "n", "chars", "bound", "first_gram", "last_gram"]
            )

    return words.mapInArrow(run, "word string, n bigint, chars int, bound int, first_gram string, last_gram string")


def _near(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def _deletions(words: DataFrame, as_word: str, as_n: str) -> DataFrame:
    """A row per deletion of each word, and one for the word itself, at -1."""
    at = F.explode(F.sequence(F.lit(-1), F.col("chars") - 1)).alias("at")
    rows = words.select(F.col("word").alias(as_word), F.col("n").alias(as_n), "chars", at)
    left = F.concat(F.expr(f"substring({as_word}, 1, at)"), F.expr(f"substring({as_word}, at + 2)"))
    return rows.select(F.when(F.col("at") < 0, F.col(as_word)).otherwise(left).alias("key"), "at", as_word, as_n)


def _halves(words: DataFrame, as_word: str, as_n: str, other: bool) -> DataFrame:
    """Rows by a word's first and last half; for the other side of a match, cut for each length the match could have."""
    of = F.explode(F.array(*[F.col("chars") + i for i in ((-1, 0, 1) if other else (0,))])).alias("of")
    rows = words.select(F.col("word").alias(as_word), F.col("n").alias(as_n), "chars", of)
    first = F.expr(f"substring({as_word}, 1, of div 2)")
    last = F.expr(f"substring({as_word}, chars - (of - of div 2) + 1)")
    keys = F.explode(F.array(F.concat(F.lit(">"), F.sha2(first, 256)), F.concat(F.lit("<"), F.sha2(last, 256)))).alias("key")
    return rows.select("of", keys, as_word, as_n)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of ``words (word, n)`` that differ by one edit.

    ``words`` has one row per word and is read several times; let it be a stored table.
    """
    spark = words.sparkSession
    sizes = words.agg(F.sum(F.length("word") + F.lit(1)).alias("places")).first()
    places = (sizes["places"] or 0) * (LONGEST - SHORTEST + 1)
    # No more than places / above grams can occur more than `above` times, which bounds what is sent to every worker.
    above = max(LIST_MOST, -(-places // DICTIONARY_MOST))
    frequent = frozenset(r["gram"] for r in frequent_grams(words, above).select("gram").collect())

    listed = materialize(word_lists(words, frequent), "word-lists")
    keys = F.explode(F.array("first_gram", "last_gram")).alias("key")
    index = listed.select("word", "n", "chars", keys).filter("key IS NOT NULL")
    long, small = materialize_measured(
        index.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > LIST_MOST).select("key"), "long-lists"
    )
    marked = listed
    for side in ("first", "last"):
        too_long = long.select(F.col("key").alias(f"{side}_gram"), F.lit(True).alias(f"{side}_long"))
        marked = join_measured(marked, too_long, small, [f"{side}_gram"], ["word"], "left")
    merged = (F.col("bound") >= 1) & F.col("first_long").isNull() & F.col("last_long").isNull()
    seen = Observation()
    left_over = F.sum(F.when(F.col("merged"), 0).otherwise(1)).alias("rest")
    marked = materialize(marked.select(*listed.columns, merged.alias("merged")).observe(seen, left_over), "word-bounds")

    probes = marked.filter("merged").select("word", "n", "chars", keys)
    others = index.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("chars").alias("near_chars"), "key")
    apart = F.abs(F.col("chars") - F.col("near_chars")) <= 1
    found = probes.join(others, "key").filter(apart & _near(F.col("word"), F.col("near"))).select("word", "n", "near", "near_n")
    if seen.get["rest"]:
        short = F.col("chars") <= LONG_WORD
        rest = marked.filter("NOT merged")
        by_deletion = _deletions(rest.filter(short), "word", "n").join(
            _deletions(listed.filter(F.col("chars") <= LONG_WORD + 1), "near", "near_n").withColumnRenamed("at", "near_at"), "key"
        )
        same_place = (F.col("at") == F.col("near_at")) & (F.col("at") >= 0)
        one_whole = (F.col("at") < 0) != (F.col("near_at") < 0)
        by_deletion = by_deletion.filter((same_place | one_whole) & (F.col("word") != F.col("near")))
        by_half = _halves(rest.filter(~short), "word", "n", False).join(
            _halves(listed.filter(F.col("chars") >= LONG_WORD), "near", "near_n", True), ["of", "key"]
        )
        by_half = by_half.filter(_near(F.col("word"), F.col("near")))
        for more in (by_deletion, by_half):
            found = found.unionByName(more.select("word", "n", "near", "near_n"))
    return found.distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms (word, form)``, following forms to the last; each round doubles the steps taken."""
    table = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = table.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = lookup_join(table, onward, ["root"], ["word"], "left", "root-steps")
        seen = Observation()
        moved = F.sum(F.when(F.col("next").isNotNull(), 1).otherwise(0)).alias("moved")
        table = materialize(stepped.observe(seen, moved).select("word", F.coalesce("next", "root").alias("root")), "roots")
        if not seen.get["moved"]:
            return table


def variants(docs: DataFrame, least_ratio: int = 5, **counting: object) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of all documents; ``counting`` goes to :func:`word_counts`.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word with the largest
    ``n`` (ties: the smallest in code-point order) if that is at least ``least_ratio`` times its own, else null. Its root is
    the end of the chain of forms, the word itself if it has no form; ``n`` grows along a chain, so it ends.

    Null, empty and repeated texts, null ids and other columns: see :func:`word_counts`. No words, no rows.
    """
    words = materialize(word_counts(docs, **counting), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near"))).alias("best")
    linked = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(linked, "word", "left")
    good = -F.col("best.least") >= least_ratio * F.col("n")
    formed = materialize(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"),
            F.when(good, -F.col("best.least")).alias("form_n"),
        ),
        "word-forms",
    )
    roots = roots_of(formed.filter("form IS NOT NULL").select("word", "form"))
    placed = formed.join(roots, "word", "left")
    return placed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
