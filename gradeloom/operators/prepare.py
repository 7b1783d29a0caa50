"""From API examples and chats to training and holdout records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.chat import compact_json_block, derive_tags, render_json_block, turn
from gradeloom.plans.skew import bucketed_rank, shuffle_hash

DEFAULT_SYSTEM_PROMPT = "Answer with one API call as a JSON object in a code block."


def with_params(examples: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``params`` (JSON text, null when absent) from ``api_call``.

    A JSON null is not the same as an absent object: strict mode raises on it, otherwise the
    row gets ``params_error`` set and can be put aside.
    """
    parts = F.from_json("api_call", "endpoint string, params string")
    keys = F.json_object_keys("api_call")
    is_null = F.coalesce(F.array_contains(keys, "params"), F.lit(False)) & parts["params"].isNull()
    df = examples.withColumn("params", parts["params"])
    if strict:
        broken = F.raise_error(F.concat(F.lit("params is null in: "), F.col("api_call"))).cast("string")
        return df.withColumn("params", F.when(is_null, broken).otherwise(F.col("params")))
    return df.withColumn("params_error", F.when(is_null, "params is null"))


def to_sharegpt(examples: DataFrame, system_prompt: str = DEFAULT_SYSTEM_PROMPT, exact: bool = True) -> DataFrame:
    """Examples as system, human and gpt turns.

    ``exact=False`` keeps the answer's JSON compact and the whole plan inside the JVM.
    """
    render = render_json_block if exact else compact_json_block
    return examples.withColumn(
        "conversations",
        F.array(
            turn("system", F.lit(system_prompt), "from", "value"),
            turn("human", F.col("question"), "from", "value"),
            turn("gpt", render(F.col("api_call")), "from", "value"),
        ),
    )


def holdout_ids(df: DataFrame, endpoint: str = "endpoint", order: str = "key", seed: int = 42, rank: str | None = None) -> DataFrame:
    """Add ``id`` = ``<endpoint>-<counter>``: zero-based per endpoint, in shuffled order.

    ``rank`` names the counter where it is known, as in :func:`gradeloom.operators.split.holdout_rows`. Four digits are the least width; larger counters keep all their digits.
    """
    if rank is not None:
        return df.withColumn("id", F.format_string("%s-%04d", F.col(endpoint), F.col(rank)))
    hashed = df.withColumn("_h", shuffle_hash(F.col(order), seed))
    ranked = bucketed_rank(hashed, endpoint, "_h", order, "_idx")
    return ranked.withColumn("id", F.format_string("%s-%04d", F.col(endpoint), F.col("_idx"))).drop("_h", "_idx")


def to_holdout(
    examples: DataFrame,
    system_prompt: str = DEFAULT_SYSTEM_PROMPT,
    endpoint: str = "endpoint",
    key: str = "key",
    seed: int = 42,
    exact: bool = True,
    strict: bool = True,
    rank: str | None = None,
) -> DataFrame:
    """Examples as holdout records: id, label, messages and structural tags; ``rank`` as in :func:`holdout_ids`."""
    render = render_json_block if exact else compact_json_block
    return (
        holdout_ids(with_params(examples, strict), endpoint, key, seed, rank)
        .withColumn("label", F.col("question"))
        .withColumn(
            "messages",
            F.array(
                turn("system", F.lit(system_prompt)),
                turn("user", F.col("question")),
                turn("assistant", render(F.col("api_call"))),
            ),
        )
        .withColumn("conventions_tested", derive_tags(F.col(endpoint), F.col("params")))
    )


def endpoint_counts(examples: DataFrame, endpoint: str = "endpoint") -> DataFrame:
    """Records per endpoint, and a total row (null endpoint) with the number of endpoints."""
    per = examples.groupBy(endpoint).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"), F.count(F.lit(1)).alias("endpoints"))
    return per.withColumn("endpoints", F.lit(1).cast("bigint")).unionByName(
        total.withColumn(endpoint, F.lit(None).cast("string"))
    )


def select_endpoints(df: DataFrame, endpoints: list[str] | None = None, endpoint: str = "endpoint") -> DataFrame:
    """Endpoint names to work on: those given, in that order, or all that have rows, by name.

    Raises when there are none. Take the rows with a left semi join.
    """
    if df.isEmpty():
        raise ValueError("no endpoints found")
    names = df.select(endpoint).distinct()
    if not endpoints:
        return names.orderBy(endpoint)
    wanted = F.array(*[F.lit(e) for e in endpoints])
    return names.filter(F.col(endpoint).isin(*endpoints)).orderBy(F.array_position(wanted, F.col(endpoint)))
