"""Mixing sources to target weights by blocks, in column expressions only.

1. The words of a source form one stream: documents lie one after another in a hashed order, found with sums per lane (a
   hashed part of a source) and sums over lanes. The stream is cut into blocks of ``BLOCK_WORDS`` words.
2. The mix is a sequence of slots, each taking one block, cut into output shards of ``SHARD_SLOTS`` slots. How many slots of a
   shard each source gets is a multinomial draw with the targets as probabilities, every shard by itself. What a source draws
   over all shards beyond its quota, the slots its target asks for, goes to the sources that drew less, in proportion to
   what they lack: a few slots per hundred in a small mix, ever fewer in a large one.
3. The slots of a source are numbered through all shards; number ``t`` takes the block at ``t mod n`` in pass ``t div n`` of a
   pseudorandom permutation of its ``n`` blocks, another one in each pass. Permutations are swap-or-not networks, which work
   for any ``n`` and need no table.
4. Blocks and the pieces of documents in them are joined by block number.

Everything random is hashed from a seed. Only tables of one row per source are sorted in one task, which is meant for
thousands of sources, not for a name per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.hypergeometric import uniform_sql
from gradeloom.plans.once import compute_once, fresh
from gradeloom.plans.skew import join_measured, materialize, materialize_measured

BLOCK_WORDS = 128
SHARD_SLOTS = 4_096
LANE_ROWS = 2_048
SLOTS_PER_TASK = 1_000_000
#: Sources take these weights in turn, and give each document this many times at most.
WEIGHTS, MOST_TIMES = (5, 2, 1), 3
ROUNDS = 32
SEED = 23
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sized_rows(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source") -> DataFrame:
    """``doc_id, source, size, text_key, no_source, named``: the last two are a source key without null."""
    rows = docs.select(
        F.col(doc).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size"), F.xxhash64(F.col(text).cast("string")).alias("text_key"),
    )
    return rows.withColumn("no_source", F.col("source").isNull()).withColumn("named", F.coalesce("source", F.lit("")))


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``sid`` (its place by code point, null last), ``weight``, ``source_size``, ``target``.

    Targets share the total by weight. Sources whose share is above ``MOST_TIMES`` times their size stop there; as the others'
    share only grows by that, those with the lowest limit per weight stop first, and one pass in that order finds them all.
    """
    sums = sized.groupBy("no_source", "named").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    place = F.row_number().over(Window.orderBy("no_source", "named")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod("sid", F.lit(len(WEIGHTS))) + 1)
    rows = sums.withColumn("sid", place).withColumn("weight", weight)
    rows = rows.withColumn("limit", F.lit(MOST_TIMES) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)

    def exact(c: Column | str) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("decimal(30,0)")

    rows = rows.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
    rows = rows.withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # Once a source does not stop, none after it does.
    rows = rows.withColumn("stops", exact("limit") * F.col("weights").cast("decimal(8,0)") <= exact("rest") * F.col("weight").cast("decimal(8,0)"))
    free = ~F.col("stops")
    rest = F.max(F.when(free, F.col("rest"))).over(everything)
    weights = F.max(F.when(free, F.col("weights"))).over(everything)
    shared = rest.cast("double") * F.col("weight") / weights
    return rows.select(
        "no_source", "named", "sid", "weight", "docs", "source_size", F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(shared).alias("target")
    )


def stream(sized: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Documents with ``sid``, ``start`` (words of the source before them) and their source's columns."""
    rows = join_measured(sized, sources, few, ["no_source", "named"], ["doc_id"])
    lanes = F.ceil(F.col("docs") / LANE_ROWS)
    rows = rows.withColumn("lane", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), lanes))
    inside = Window.partitionBy("sid", "lane").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id"), "doc_id", "text_key", "size")
    rows = rows.withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    over_lanes = Window.partitionBy("sid").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("sid", "lane").agg(F.sum("size").alias("n"))
    sums = sums.select("sid", "lane", F.coalesce(F.sum("n").over(over_lanes), F.lit(0)).alias("lane_start"))
    return rows.join(sums, ["sid", "lane"]).withColumn("start", F.col("lane_start") + F.col("within")).drop("lane", "within", "lane_start")


def pieces(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``sid, block, start, first_word, words``: what of each document lies in each block of its source.

    ``(sid, start)`` tells documents with words apart, also when their ids repeat.
    """
    full = rows.filter("size > 0")
    last = F.expr(f"(start + size - 1) div {block_words}")
    out = full.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), last)))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return out.select(*[c for c in rows.columns], "block", (begin - F.col("start")).alias("first_word"), (end - begin).alias("words"))


def permuted(index: str, n: str, *key: str) -> str:
    """SQL for the place of ``index`` in a pseudorandom permutation of 0 to n - 1: a swap-or-not network."""
    keys = ", ".join(key)
    partner = f"pmod(pmod(xxhash64({SEED + 2}, {keys}, r), {n}) - x + {n}, {n})"
    swap = f"IF(xxhash64({SEED + 3}, {keys}, r, greatest(x, y)) & 1 = 1, y, x)"
    return f"aggregate(sequence(1, {ROUNDS}), {index}, (x, r) -> element_at(transform(array({partner}), y -> {swap}), 1))"


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``shard, slot, sid, block, turn``: the mix, one row per slot; ``turn`` counts the passes over a source's blocks."""
    everything = Window.partitionBy()
    by_sid = Window.orderBy("sid")
    upto = by_sid.rowsBetween(Window.unboundedPreceding, 0)
    rows = sources.filter("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block_words))
    # A source's last block may be short, so its quota counts blocks, not words.
    rows = rows.withColumn("quota", F.col("target") * F.col("blocks") / F.col("source_size"))
    rows = rows.withColumn("all_slots", F.round(F.sum("quota").over(everything)).cast("bigint"))
    rows = rows.withColumn("share", F.col("quota") / F.sum("quota").over(everything))
    rows = rows.withColumn("shards", F.expr(f"(all_slots + {shard_slots} - 1) div {shard_slots}"))
    # Full shards, and the last one, which may be shorter.
    kinds = F.explode(F.expr(f"filter(array(named_struct('first', 0L, 'last', shards - 2, 'room', {shard_slots}L), named_struct('first', shards - 1, 'last', shards - 1, 'room', all_slots - (shards - 1) * {shard_slots})), k -> k.last >= k.first)"))
    rows = materialize(rows.withColumn("kind", kinds), "shares").select("*", "kind.*")
    of_kind = Window.partitionBy("first").orderBy("sid")
    rows = rows.withColumn("high", F.sum(F.col("room") * F.col("share")).over(of_kind.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("low", F.coalesce(F.lag("high").over(of_kind), F.lit(0.0)))
    rows = rows.withColumn("high", F.when(F.lead("sid").over(of_kind).isNull(), F.col("room") + 1.0).otherwise(F.col("high")))
    total = rows.agg(F.max("all_slots").alias("n")).first()["n"] or 0
    # Few narrow rows become many slots: they are dealt out by what they become.
    parts = max(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SLOTS_PER_TASK)
    # The draw: a point per slot, found by its whole number among the sources' stretches.
    shards = rows.select("first", "room", F.explode(F.sequence("first", "last")).alias("shard")).distinct().repartition(parts, "shard")
    draws = shards.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("room") - 1)))
    draws = draws.withColumn("point", F.col("room") * F.expr(uniform_sql(f"{SEED + 4}", "shard", "i"))).withColumn("cell", F.floor("point"))
    stretches = rows.filter("high > low").select("first", "sid", "low", "high", F.explode(F.sequence(F.floor("low"), F.floor("high"))).alias("cell"))
    drawn = draws.join(stretches, ["first", "cell"]).filter("point >= low AND point < high").select("shard", "sid")
    counts = materialize(drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n")), "counts")

    # Beyond a source's quota: the surplus, numbered, goes to sources with room. Quotas are whole numbers that add up; what
    # rounding down leaves goes to the largest fractions, so a source at its limit of passes stays there.
    sums = counts.groupBy("sid").agg(F.sum("n").alias("slots"))
    quotas = rows.groupBy("sid").agg(F.max("blocks").alias("blocks"), F.max("quota").alias("quota"), F.max("all_slots").alias("all_slots"))
    quotas = quotas.withColumn("limit", F.floor(F.col("quota") + 1e-6))
    left = F.col("all_slots") - F.sum("limit").over(everything)
    largest = F.row_number().over(Window.orderBy((F.col("quota") - F.col("limit")).desc(), "sid"))
    quotas = quotas.withColumn("limit", F.col("limit") + F.when(largest <= left, 1).otherwise(0))
    room = quotas.join(sums, "sid", "left").select("sid", "blocks", F.coalesce("slots", F.lit(0)).alias("slots"), "limit")
    room = room.withColumn("over", F.greatest(F.col("slots") - F.col("limit"), F.lit(0))).withColumn("free", F.greatest(F.col("limit") - F.col("slots"), F.lit(0)))
    room = room.withColumn("over_before", F.sum("over").over(upto) - F.col("over"))
    room = room.withColumn("free_upto", F.sum("free").over(upto)).withColumn("over_all", F.sum("over").over(everything)).withColumn("free_all", F.sum("free").over(everything))

    def dealt(upto: str) -> Column:
        return F.when(F.col("free_all") > 0, F.expr(f"CAST(floor(CAST({upto} AS DECIMAL(19,0)) * CAST(over_all AS DECIMAL(19,0)) / CAST(free_all AS DECIMAL(19,0))) AS BIGINT)")).otherwise(F.lit(0))

    room = room.withColumn("extra_upto", dealt("free_upto")).withColumn("extra", F.col("extra_upto") - dealt("(free_upto - free)"))
    room, few = materialize_measured(room, "room")
    extras = room.filter("extra > 0").select(F.col("sid").alias("to"), "slots", "extra", "extra_upto", F.posexplode(F.expr("sequence(1L, extra)")).alias("e", "_"))
    extras = extras.select((F.col("extra_upto") - F.col("extra") + F.col("e")).alias("o"), "to", (F.col("slots") + F.col("e")).alias("to_t"))

    through = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumn("from", F.sum("n").over(through) - F.col("n"))
    rows = rows.repartition(parts, "shard", "sid").select("shard", "sid", F.explode(F.expr("sequence(from, from + n - 1)")).alias("t"))
    # The surplus is taken out evenly, every so many slots, so that no shard is left far from its draw.
    limits = room.select("sid", "over", "over_before", F.expr("slots div greatest(over, 1L)").alias("stride"))
    rows = join_measured(rows, limits, few, ["sid"], ["t"])
    rows = rows.withColumn("gone", F.expr("least((t + 1) div greatest(stride, 1L), over)"))
    surplus = F.expr("over > 0 AND (t + 1) % stride = 0 AND (t + 1) div stride <= over")
    moved = rows.filter(surplus).withColumn("o", F.col("over_before") + F.col("gone") - 1).join(extras, "o")
    moved = moved.select("shard", F.col("to").alias("sid"), F.col("to_t").alias("t"))
    taken = rows.filter(~surplus).select("shard", "sid", (F.col("t") - F.col("gone")).alias("t")).unionByName(moved)
    taken = join_measured(taken, room.select("sid", "blocks"), few, ["sid"], ["t"])
    taken = taken.withColumn("turn", F.expr("t div blocks")).withColumn("block", F.expr(permuted("pmod(t, blocks)", "blocks", "sid", "t div blocks")))
    mixed = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED + 5), "sid", "t"), "sid", "t")
    return taken.select("shard", (F.row_number().over(mixed) - 1).cast("int").alias("slot"), "sid", F.col("block").cast("bigint").alias("block"), "turn")


def mix(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source", block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame]:
    """The mix, and the documents it was made from.

    The first table has a row per piece of a document in a slot: ``shard, slot, sid, block, turn, start, first_word, words`` and the
    document's ``doc_id, source``; the second ``doc_id, source, size, sid, start, source_size, target``.

    A null text has no words, is in no block and is not taken; null is a source of its own, the last one. Rows that repeat
    an id are documents of their own. Sources without words get the target 0. An empty table gives empty results; other
    columns are not read.
    """
    sized = materialize(sized_rows(docs, text, doc, source), "sized")
    sources, few = materialize_measured(targets(sized), "targets")
    rows = materialize(stream(sized, sources, few), "stream").drop("no_source", "named", "docs", "weight")
    chosen = slots(sources, block_words, shard_slots)
    return chosen.join(pieces(rows, block_words), ["sid", "block"]), rows


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words of each document that the mix takes, repeats counted."""
    mixed, rows = mix(docs, **options)
    taken = mixed.groupBy("sid", "start").agg(F.sum("words").alias("taken"))
    empty = rows.filter("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    full = rows.filter("size > 0").join(taken, ["sid", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
    return full.unionByName(empty).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source", block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each of its pieces in the mix, ``text`` being the piece.

    A piece keeps the white space behind its words, the first one also what stands before them. All other columns are those
    of the document, whatever their names. Rows that repeat both id and text are one document here (of several, the first by its
    other columns); their pieces are all kept. A text is cut in one pass into the stretches between blocks, never into words.
    """
    mixed, rows = mix(docs, text, doc, source, block_words=block_words, shard_slots=shard_slots)
    # Working columns have names that no column of the documents has.
    own = [f"`{c}`" for c in docs.columns]
    of_doc, of_text, whole, numbers, head, cut, piece, key_doc, key_text = fresh(
        docs.columns, "of_doc", "of_text", "whole", "numbers", "head", "cut", "piece", "key_doc", "key_text"
    )
    string = F.col(f"`{text}`").cast("string")
    keyed = docs.withColumns({of_doc: F.col(f"`{doc}`").cast("bigint"), of_text: F.xxhash64(string), whole: string})
    if not rows.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():
        first = F.min_by(F.struct(*own, whole), F.to_json(F.struct(*own))).alias(piece)
        keyed = keyed.groupBy(of_doc, of_text).agg(first).select(f"{piece}.*", of_doc, of_text)
    # A document's own pieces: as many as it has blocks, MOST_TIMES times.
    number = F.expr(f"IF(first_word = 0, 0L, 1L + (first_word - head_words) div {block_words})").cast("int")
    mixed = mixed.withColumn("head_words", F.expr(f"least(size, {block_words} - start % {block_words})")).withColumn("number", number)
    taken = mixed.groupBy("doc_id", "text_key", "sid", "start", "head_words").agg(F.collect_list("number").alias("numbers"))
    taken = taken.select(
        F.col("doc_id").alias(key_doc), F.col("text_key").alias(key_text), F.col("head_words").alias(head), F.col("numbers").alias(numbers)
    )
    found = keyed.join(taken, keyed[of_doc].eqNullSafe(taken[key_doc]) & (keyed[of_text] == taken[key_text]))
    found = compute_once(found.select(*own, whole, numbers, head), {cut: stretches_of(F.col(whole), F.col(head), block_words)})
    pieces_of = found.select(*own, F.explode(F.transform(numbers, lambda n: F.get(cut, n))).alias(piece))
    return pieces_of.select(*[F.col(piece).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def stretches_of(text: Column, head_words: Column, block_words: int) -> Column:
    """A text cut after its first ``head_words`` words and then after every ``block_words``, white space kept in front of the
    cuts."""
    word = rf"{WORD}+[\x20\x09-\x0D]*+"
    pattern = F.concat(F.lit(rf"\A[\x20\x09-\x0D]*+(?:{word}){{"), head_words.cast("string"), F.lit("}"))
    head = F.call_function("regexp_extract", text, pattern, F.lit(0))
    rest = F.transform(F.array(head), lambda h: F.concat(F.array(h), F.regexp_extract_all(F.substr(text, F.length(h) + 1), F.lit(f"(?:{word}){{1,{block_words}}}"), F.lit(0))))
    return F.get(rest, F.lit(0))
