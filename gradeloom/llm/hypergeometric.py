"""Exact uniform sharding by a communication matrix of hypergeometric counts, in column expressions only.

1. Rows are dealt to blocks by a hash of their id and counted. Blocks take the part of the sending side.
2. The matrix says how many rows of each block go to each cell; a shard is a run of cells of fixed sizes. Given the sizes
   of blocks and cells, the counts of a uniform shuffle are multivariate hypergeometric. They are drawn down a binary tree of
   blocks: a node's rows, known by cell, are divided among its halves, cell after cell, each count from its exact
   conditional law. Rows and columns therefore add up exactly.
3. Inside a block rows are put in pseudorandom order and cut at the counts; after the exchange each cell is put in a new
   pseudorandom order, which gives the slots.

All randomness is hashed from a seed, so a task run again, or a second run, deals alike. No step holds more than a block's or
cell's narrow rows in one task; the matrix has one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.plans.skew import materialize

BLOCK_ROWS = CELL_ROWS = 2_000_000
#: Blocks and cells there are at least, so that small tables use several tasks as well.
LEAST_BLOCKS, LEAST_CELLS = 32, 2
SEED = 17


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` under a name, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def draw_sql(good: str, total: str, drawn: str, u: str) -> str:
    """SQL for a hypergeometric count: of ``drawn`` out of ``total``, how many are among ``good``.

    The probabilities relative to the mode follow by recurrence in both directions, as far as ten standard deviations; ``u``
    picks the outcome in the order mode, one up, one down, and so on.
    """
    up = "a.up * ((p.g - p.mode - i + 1) * (p.d - p.mode - i + 1)) / ((p.mode + i) * (p.t - p.g - p.d + p.mode + i))"
    down = "a.down * ((p.mode - i + 1) * (p.t - p.g - p.d + p.mode - i + 1)) / ((p.g - p.mode + i) * (p.d - p.mode + i))"
    summed = _let("x", f"named_struct('up', {up}, 'down', {down})", "named_struct('up', x.up, 'down', x.down, 'sum', a.sum + x.up + x.down)")
    weight = f"aggregate(sequence(1, p.w), named_struct('up', 1D, 'down', 1D, 'sum', 1D), (a, i) -> {summed}, a -> a.sum)"
    picked = _let(
        "x", f"named_struct('up', {up}, 'down', {down})",
        "named_struct('up', x.up, 'down', x.down, 'rest', a.rest - x.up - x.down, 'k', CASE WHEN a.k IS NOT NULL THEN a.k"
        " WHEN a.rest < x.up THEN p.mode + i WHEN a.rest < x.up + x.down THEN p.mode - i END)",
    )
    start = f"named_struct('up', 1D, 'down', 1D, 'rest', p.u * {weight} - 1D, 'k', CAST(NULL AS DOUBLE))"
    start = _let("s", start, "named_struct('up', 1D, 'down', 1D, 'rest', s.rest, 'k', IF(s.rest < 0D, p.mode, NULL))")
    walk = f"CAST(coalesce(aggregate(sequence(1, p.w), {start}, (a, i) -> {picked}, a -> a.k), p.mode) AS BIGINT)"
    lowest, highest = "greatest(0D, p.d - (p.t - p.g))", "least(p.d, p.g)"
    mode = f"greatest({lowest}, least({highest}, floor((p.d + 1D) * (p.g + 1D) / (p.t + 2D))))"
    spread = "sqrt(p.d * p.g / greatest(p.t, 1D) * (p.t - p.g) / greatest(p.t, 1D) * (p.t - p.d) / greatest(p.t - 1D, 1D))"
    width = f"CAST(greatest(1D, least({highest} - {lowest}, ceil(10D * {spread}) + 10D)) AS INT)"
    given = f"named_struct('g', CAST({good} AS DOUBLE), 't', CAST({total} AS DOUBLE), 'd', CAST({drawn} AS DOUBLE), 'u', {u})"
    full = f"named_struct('g', p.g, 't', p.t, 'd', p.d, 'u', p.u, 'mode', CAST({mode} AS DOUBLE), 'w', {width})"
    return _let("p", given, _let("p", full, walk))


def uniform_sql(*parts: str) -> str:
    """SQL for a number in [0, 1) hashed from the parts."""
    return f"shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992D"


def _halves(nodes: DataFrame, level: int, seed: int) -> DataFrame:
    """Both halves of every node ``(node, sizes, caps)``: its blocks' sizes, and its rows by cell."""
    total = "aggregate(caps, 0L, (s, c) -> s + c)"
    u = uniform_sql(f"{seed}L", f"{level}L", "node", "size(s.out)")
    step = _let(
        "k", draw_sql("cap", "s.total", "s.want", u),
        "named_struct('want', s.want - k, 'total', s.total - cap, 'out', concat(s.out, array(k)))",
    )
    begin = f"named_struct('want', aggregate(slice(sizes, 1, size(sizes) div 2), 0L, (s, c) -> s + c), 'total', {total}, 'out', CAST(array() AS ARRAY<BIGINT>))"
    drawn = nodes.withColumn("left", F.expr(f"aggregate(caps, {begin}, (s, cap) -> {step}, s -> s.out)"))
    left = "named_struct('node', node * 2, 'sizes', slice(sizes, 1, size(sizes) div 2), 'caps', left)"
    right = (
        "named_struct('node', node * 2 + 1, 'sizes', slice(sizes, size(sizes) div 2 + 1, size(sizes)),"
        " 'caps', zip_with(caps, left, (c, l) -> c - l))"
    )
    return drawn.select(F.expr(f"inline(array({left}, {right}))"))


def communication_matrix(sizes: DataFrame, blocks: int, cells: DataFrame, seed: int = SEED) -> DataFrame:
    """``block, counts``: the rows of each block for each cell, in cell order.

    ``sizes (block, n)`` may leave out empty blocks; ``blocks`` is a power of two; ``cells (cell, m)`` has as many rows in all.
    One number per block and per cell meets in one row: tables have a block per ``BLOCK_ROWS`` rows.
    """
    every = sizes.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    filled = every.join(sizes, "block", "left").select("block", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    # Both lists in one row, by one aggregate.
    sides = filled.select(F.lit("s").alias("side"), F.col("block").alias("at"), "n").unionByName(
        cells.select(F.lit("c").alias("side"), F.col("cell").cast("int").alias("at"), F.col("m").cast("bigint").alias("n"))
    )
    listed = [F.sort_array(F.collect_list(F.when(F.col("side") == x, F.struct("at", "n")))).alias(x) for x in ("s", "c")]
    root = sides.agg(*listed)
    nodes = root.select(F.lit(0).cast("bigint").alias("node"), F.col("s.n").alias("sizes"), F.col("c.n").alias("caps"))
    for level in range(blocks.bit_length() - 1):
        nodes = _halves(nodes, level, seed)
        if level % 6 == 5:
            nodes = materialize(nodes, "matrix")
    return nodes.select(F.col("node").cast("int").alias("block"), F.col("caps").alias("counts"))


def shuffle_into_shards(
    docs: DataFrame, shards: int = 16, text: str = "text", doc: str = "doc_id", with_text: bool = False, seed: int = SEED,
    block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` (and ``text``): a uniform shuffle into shards.

    Shards differ by one row at most, the first ones being larger (law ``rows``; ``grown_shard`` is null). ``slot`` runs from 0
    without gaps. ``size`` is the text's UTF-8 bytes plus 1; a null or empty text has size 1 and
    crc 0. A null ``doc_id`` is an id like any other. Rows that repeat an id are dealt one by one; wholly equal
    rows may change places. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(
        F.col(doc).cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_crc32"),
        *([F.col(text).alias("text")] if with_text else []),
    )
    n = docs.count()
    blocks = max(LEAST_BLOCKS, 1 << max(0, (-(-n // block_rows) - 1).bit_length()))
    per_shard = max(LEAST_CELLS, -(-n // (shards * cell_rows)))
    block = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(blocks)).cast("int").alias("block")
    sizes = docs.select(F.col(doc).cast("bigint").alias("doc_id")).groupBy(block).agg(F.count(F.lit(1)).alias("n"))

    # Shard s has n // shards rows, and one more if s < n % shards; its cells divide those in the same way.
    def share(of: str, parts: int, index: str) -> str:
        return f"({of} div {parts} + IF({index} < {of} % {parts}, 1, 0))"

    cells = docs.sparkSession.range(shards * per_shard).selectExpr(
        "CAST(id AS INT) AS cell", f"CAST(id div {per_shard} AS INT) AS shard", f"id % {per_shard} AS part"
    )
    cells = cells.withColumn("in_shard", F.expr(share(f"{n}L", shards, "shard")))
    cells = cells.withColumn("m", F.expr(share("in_shard", per_shard, "part")))
    cells = cells.withColumn("start", F.expr(f"part * (in_shard div {per_shard}) + least(part, in_shard % {per_shard})"))

    matrix = communication_matrix(sizes, blocks, cells.select("cell", "m"), seed)
    # The last row of each cell in the order of the block.
    step = "named_struct('sum', s.sum + c, 'out', concat(s.out, array(s.sum + c)))"
    begin = "named_struct('sum', 0L, 'out', CAST(array() AS ARRAY<BIGINT>))"
    ends = matrix.select("block", F.expr(f"aggregate(counts, {begin}, (s, c) -> {step}, s -> s.out)").alias("ends"))
    ends = materialize(ends, "ends")

    ties = ["doc_id", "text_crc32", "size"]
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), *ties), *ties)
    placed = rows.withColumn("block", block).withColumn("place", F.row_number().over(local) - 1).join(ends, "block")
    # Binary search: how many cells end at or before this place.
    steps = [1 << i for i in reversed(range((shards * per_shard).bit_length()))]
    search = f"aggregate(array({', '.join(map(str, steps))}), 0, (p, h) -> IF(p + h <= size(ends) AND try_element_at(ends, p + h) <= place, p + h, p))"
    placed = placed.withColumn("cell", F.expr(search)).drop("block", "place", "ends")
    again = Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed + 2), *ties), *ties)
    slotted = placed.withColumn("place", F.row_number().over(again) - 1)
    # One row per cell; the shard's arithmetic is repeated here rather than joined.
    shard = F.expr(f"cell div {per_shard}").cast("int")
    in_shard = share(f"{n}L", shards, f"(cell div {per_shard})")
    start = F.expr(f"(cell % {per_shard}) * ({in_shard} div {per_shard}) + least(cell % {per_shard}, {in_shard} % {per_shard})")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"), (start + F.col("place")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["text"] if with_text else []),
    )
