"""Preparation, split and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import chat
from gradeloom.operators import prepare, split, validate
from gradeloom.plans import sqltext as q
from gradeloom.plans.registry import query
from gradeloom.plans.standins import EXAMPLE_BLOCK_SQL, EXAMPLE_TAGS_SQL, EXAMPLES_SQL, examples, table

PROMPT = "You turn requests into API calls."
E = q.ctes(EXAMPLES_SQL)
NL = "chr(10)"


def split_sql(source: str, stratum: str, key: str, frac: str = "0.1", seed: int = 42) -> str:
    """The split by ranking whole strata, as one would in SQL."""
    return f"""split AS (SELECT *, CASE WHEN rn <= greatest(1, round_even(n * CAST({frac} AS DOUBLE), 0)) THEN 'holdout' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('{seed}:' || {key}), {key}) AS rn,
    count(*) OVER (PARTITION BY {stratum}) AS n FROM {source}))"""


SPLIT = split_sql("examples", "endpoint", "key")
DOC_SPLIT = split_sql("documents", "source", "doc_id")


def split_examples(spark, sf):
    return split.stratified_split(examples(spark, sf), "endpoint", "key")


def ids_sql(source: str) -> str:
    return f"""ids AS (SELECT *, endpoint || '-' || CASE WHEN c < 10000 THEN lpad(CAST(c AS VARCHAR), 4, '0') ELSE CAST(c AS VARCHAR) END AS id
  FROM (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY md5('42:' || key), key) - 1 AS c FROM {source}))"""


@query("to_sharegpt", E + f"""SELECT key, '{PROMPT}' AS system, question AS human, {EXAMPLE_BLOCK_SQL} AS gpt, 'system,human,gpt' AS speakers FROM examples""")
def _(spark, sf):
    turns = prepare.to_sharegpt(examples(spark, sf), PROMPT)
    c = F.col("conversations")
    return turns.select(
        "key",
        c[0]["value"].alias("system"),
        c[1]["value"].alias("human"),
        c[2]["value"].alias("gpt"),
        F.array_join(F.transform(c, lambda t: t["from"]), ",").alias("speakers"),
    )


@query("render_json_block", E + f"SELECT key, {EXAMPLE_BLOCK_SQL} AS block FROM examples")
def _(spark, sf):
    return examples(spark, sf).select("key", chat.render_json_block(F.col("api_call")).alias("block"))


@query("compact_json_block", E + f"SELECT key, '```json' || {NL} || api_call || {NL} || '```' AS block FROM examples")
def _(spark, sf):
    return examples(spark, sf).select("key", chat.compact_json_block(F.col("api_call")).alias("block"))


@query("derive_tags", E + f"SELECT key, {EXAMPLE_TAGS_SQL} AS tags FROM examples")
def _(spark, sf):
    ex = prepare.with_params(examples(spark, sf))
    return ex.select("key", F.array_join(chat.derive_tags(F.col("endpoint"), F.col("params")), ",").alias("tags"))


@query("to_holdout", q.ctes(EXAMPLES_SQL, SPLIT, ids_sql("(SELECT * FROM split WHERE split = 'holdout')")) + f"""
SELECT id, question AS label, {EXAMPLE_TAGS_SQL} AS tags, '{PROMPT}' AS system, {EXAMPLE_BLOCK_SQL} AS assistant FROM ids""")
def _(spark, sf):
    held = split.holdout_rows(examples(spark, sf), "endpoint", "key")
    recs = prepare.to_holdout(held, PROMPT, rank="split_rank")
    return recs.select(
        "id",
        "label",
        F.array_join("conventions_tested", ",").alias("tags"),
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[2]["content"].alias("assistant"),
    )


@query("holdout_ids", q.ctes(EXAMPLES_SQL, ids_sql("examples")) + "SELECT key, id FROM ids")
def _(spark, sf):
    return prepare.holdout_ids(examples(spark, sf)).select("key", "id")


@query("stratified_split", q.ctes(DOC_SPLIT) + "SELECT doc_id, source, split FROM split")
def _(spark, sf):
    return split.stratified_split(table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id")


@query("stratified_split_by_lang", q.ctes(split_sql("documents", "lang", "doc_id", "0.25", 7)) + "SELECT doc_id, lang, split, md5(text) AS text FROM split")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    out = split.stratified_split(docs, "lang", "doc_id", frac=0.25, seed=7)
    return out.select("doc_id", "lang", "split", F.md5("text").alias("text"))


@query("shuffled", q.ctes(DOC_SPLIT) + "SELECT doc_id, md5('43:' || doc_id) AS place FROM split WHERE split = 'train' ORDER BY place, doc_id")
def _(spark, sf):
    docs = split.stratified_split(table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id")
    out = split.shuffled(docs.filter("split = 'train'"), "doc_id")
    return out.select("doc_id", F.md5(F.concat(F.lit("43:"), "doc_id")).alias("place"))


COUNTS = """counts AS (SELECT endpoint, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'holdout') AS n_holdout
  FROM split GROUP BY endpoint)"""


@query("split_counts", q.ctes(EXAMPLES_SQL, SPLIT, COUNTS) + "SELECT *, n_holdout / CAST(n_train + n_holdout AS DOUBLE) AS holdout_share FROM counts")
def _(spark, sf):
    return split.split_counts(split_examples(spark, sf))


PLAN_SQL = """SELECT key, n_train, b AS batch_size, a AS gradient_accumulation_steps, m AS max_steps,
  greatest(25, least(100, m // 4)) AS save_steps
FROM (SELECT *, CAST(greatest(least_steps, epochs * greatest(1, CAST(ceil(n_train / CAST(b * a AS DOUBLE)) AS BIGINT))) AS BIGINT) AS m
  FROM (SELECT *, CASE WHEN n_train < 32 THEN 2 WHEN n_train < 96 THEN 4 ELSE 8 END::BIGINT AS b,
    CASE WHEN n_train < 96 THEN 1 ELSE 2 END::BIGINT AS a, CASE WHEN n_train < 96 THEN 12 ELSE 10 END AS epochs,
    CASE WHEN n_train < 96 THEN 96 ELSE 80 END AS least_steps FROM plan_counts))"""
PLAN_FIELDS = ("n_train", "batch_size", "gradient_accumulation_steps", "max_steps", "save_steps")


@query("training_plan", q.ctes(split_sql("(SELECT source || '/' || lang AS stratum, doc_id FROM documents)", "stratum", "doc_id"),
    "plan_counts AS (SELECT stratum AS key, count(*) FILTER (split = 'train') AS n_train FROM split GROUP BY stratum)") + PLAN_SQL)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("stratum"))
    counts = split.split_counts(split.stratified_split(docs, "stratum", "doc_id"), "stratum")
    return split.training_plan(counts).select(F.col("stratum").alias("key"), *PLAN_FIELDS)


@query("endpoint_counts", E + """SELECT endpoint, count(*) AS n, CAST(1 AS BIGINT) AS endpoints FROM examples GROUP BY endpoint
UNION ALL SELECT NULL, count(*), count(DISTINCT endpoint) FROM examples""")
def _(spark, sf):
    return prepare.endpoint_counts(examples(spark, sf))


@query("select_endpoints", E + "SELECT key, endpoint FROM examples WHERE endpoint IN ('view', 'click')")
def _(spark, sf):
    ex = examples(spark, sf)
    return ex.join(prepare.select_endpoints(ex, ["view", "click"]), "endpoint", "left_semi").select("key", "endpoint")


@query("discover_endpoints", E + "SELECT DISTINCT endpoint FROM examples ORDER BY endpoint")
def _(spark, sf):
    return prepare.select_endpoints(examples(spark, sf))


@query("by_name", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY source")
def _(spark, sf):
    return split.by_name(table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source")


# Chats as one array per example: system, user, assistant, a follow-up user turn and an unknown speaker.
def chats(spark, sf):
    ex = examples(spark, sf)
    said = F.col("question")

    def say(who: str, what):
        return chat.turn(who, what, "from", "value")

    full = F.array(
        say("system", F.lit(PROMPT)), say("human", said), say("gpt", F.col("api_call")),
        say("human", F.concat(said, F.lit(" again"))), say("tool", F.lit("ok")),
    )
    unanswered = F.array(say("human", said), say("human", F.lit("anyone?")))
    unasked = F.array(say("system", F.lit(PROMPT)), say("gpt", F.col("api_call")))
    rule = F.pmod("key", F.lit(4))
    convs = F.when(rule == 0, unanswered).when(rule == 1, unasked).otherwise(full)
    return ex.select("key", convs.alias("conversations")).withColumn(
        "messages", chat.standardize_sharegpt(F.col("conversations"))
    )


CHATS_SQL = f"""chats AS (SELECT key, question AS said, api_call, CASE key % 4
    WHEN 0 THEN [['user', question], ['user', 'anyone?']]
    WHEN 1 THEN [['system', '{PROMPT}'], ['assistant', api_call]]
    ELSE [['system', '{PROMPT}'], ['user', question], ['assistant', api_call], ['user', question || ' again'], ['tool', 'ok']] END AS m
  FROM examples)"""
C = q.ctes(EXAMPLES_SQL, CHATS_SQL)


def flat(col):
    return F.array_join(F.transform(col, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")


def flat_sql(m: str) -> str:
    return f"array_to_string(list_transform({m}, lambda x: x[1] || '=' || x[2]), '|')"


@query("standardize_sharegpt", C + f"SELECT key, {flat_sql('m')} AS chat FROM chats")
def _(spark, sf):
    return chats(spark, sf).select("key", flat(F.col("messages")).alias("chat"))


@query("request_messages", C + "SELECT key, " + flat_sql("list_filter(m, lambda x: x[1] <> 'assistant')") + " AS request FROM chats")
def _(spark, sf):
    return chats(spark, sf).select("key", flat(chat.request_messages(F.col("messages"))).alias("request"))


@query("first_by_role", C + "SELECT key, list_filter(m, lambda x: x[1] = 'user')[1][2] AS prompt, list_filter(m, lambda x: x[1] = 'assistant')[1][2] AS expected FROM chats")
def _(spark, sf):
    m = F.col("messages")
    return chats(spark, sf).select(
        "key", chat.first_by_role(m, "user").alias("prompt"), chat.first_by_role(m, "assistant").alias("expected")
    )


@query("override_system", C + "SELECT key, " + flat_sql("list_concat([['system', 'Be brief.']], list_filter(m, lambda x: x[1] = 'user'))") + " AS request FROM chats")
def _(spark, sf):
    return chats(spark, sf).select("key", flat(chat.override_system(F.col("messages"), "Be brief.")).alias("request"))


@query("render_chat", C + f"""SELECT key, array_to_string(list_transform(m, lambda x: '<|im_start|>' || x[1] || {NL} || x[2] || '<|im_end|>' || {NL}), '') AS text FROM chats""")
def _(spark, sf):
    return chats(spark, sf).select("key", chat.render_chat(F.col("messages")).alias("text"))


# Lines of the conversation format with every kind of fault, by document; all but the blank ones hold its whole text.
def sharegpt_lines(spark, sf):
    text, rule = F.col("text"), F.pmod("doc_id", F.lit(8))
    good = F.to_json(F.struct(F.array(F.struct(F.lit("human").alias("from"), text.alias("value"))).alias("conversations")))
    said = F.coalesce(text, F.lit(""))
    # {"text":"..."} without its last brace; a fault that follows it is met only when the text is read through.
    held = F.regexp_replace(F.to_json(F.struct(said.alias("text"))), r"\}\z", "")
    inner = F.regexp_replace(held, r"\A\{", "")
    line = (
        F.when(rule == 1, F.concat(held, F.lit(" bad")))
        .when(rule == 2, F.concat(held, F.lit(', "messages": []}')))
        .when(rule == 3, F.concat(held, F.lit(', "conversations": []}')))
        .when(rule == 4, F.to_json(F.struct(said.alias("conversations"))))
        .when(rule == 5, F.concat(F.lit('{"conversations": [{"role": "user", '), inner, F.lit("}]}")))
        .when(rule == 6, F.lit("  "))
        .when(rule == 7, F.concat(F.lit("[1, "), held, F.lit("}]")))
        .otherwise(good)
    )
    return table(spark, sf, "documents").select(
        line.alias("value"), (F.col("doc_id") + 1).alias("line_no"),
        (F.col("doc_id") + 1 - F.floor((F.col("doc_id") + 1) / 8)).cast("bigint").alias("record_no"),
    )


VIOLATIONS = """SELECT * FROM (SELECT doc_id + 1 AS line_no, doc_id + 1 - (doc_id + 1) // 8 AS record_no, CASE doc_id % 8
  WHEN 1 THEN 'not valid JSON' WHEN 2 THEN 'no conversations key' WHEN 3 THEN 'conversations is not a non-empty list'
  WHEN 4 THEN 'conversations is not a non-empty list' WHEN 5 THEN 'first turn lacks from or value'
  WHEN 7 THEN 'record is not an object' END AS reason FROM documents) WHERE reason IS NOT NULL"""


@query("validate_sharegpt", VIOLATIONS)
def _(spark, sf):
    return validate.validate_sharegpt(sharegpt_lines(spark, sf))


@query("validate_first_records", VIOLATIONS + " AND record_no <= 3")
def _(spark, sf):
    return validate.validate_sharegpt(sharegpt_lines(spark, sf), first_n=3)


@query("grade_size", """SELECT source, n_records, CASE WHEN n_records < 100 THEN 'likely underfit' WHEN n_records < 500 THEN 'consider more' ELSE 'ok' END AS grade
FROM (SELECT source, count(*) AS n_records FROM documents GROUP BY source UNION ALL SELECT 'all', count(*) FROM documents)""")
def _(spark, sf):
    from gradeloom.functions.rules import grade_records

    docs = table(spark, sf, "documents").select("source")
    per = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_records")).withColumn("grade", grade_records(F.col("n_records")))
    return per.unionByName(validate.grade_size(docs).withColumn("source", F.lit("all")))
