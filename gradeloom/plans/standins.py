"""Inputs of the engine derived from the driver tables, in Spark and in SQL.

Records come from ``conversations``, API examples, logs and run histories from ``events``,
strata and code-like answers from ``documents``. Nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.logs import LOSS_LINE
from gradeloom.operators.scoring import attach_predictions, score_results
from gradeloom.plans import sqltext as q

BASE_RUN = "2026-01-02_0900_base"
OLD_RUN = "2026-01-02_1000_adapter"
NEW_RUN = "2026-01-03_1000_adapter"
# run_id, model, shift of the answer rule
RUNS = ((BASE_RUN, "base", 0), (OLD_RUN, "adapter", 1), (NEW_RUN, "adapter", 2))
RUN_IDS = [r[0] for r in RUNS]
# A sign found in no text, so that a marked answer is not a prefix of its reference.
MARK = "∎∎∎"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- records and answers

def records(spark: SparkSession, sf: str) -> DataFrame:
    """One holdout record per conversation: first user and assistant turn, and tags.

    Aggregates that combine map-side, so a very long conversation is never gathered.
    """
    turns = table(spark, sf, "conversations")
    return (
        turns.groupBy(F.col("conv_id").alias("rec_id"))
        .agg(
            F.expr("min_by(text, turn) FILTER (WHERE role = 'assistant')").alias("expected"),
            F.expr("min_by(text, turn) FILTER (WHERE role = 'user')").alias("prompt"),
            F.max_by("role", "turn").alias("_last"),
            F.count_if(F.col("role") == "user").alias("_users"),
            F.count_if(F.col("role") == "system").alias("_systems"),
            F.count(F.lit(1)).alias("_turns"),
        )
        .select(
            "rec_id",
            F.col("rec_id").alias("ord"),
            F.concat(F.lit("c"), F.floor(F.col("rec_id") / 2)).alias("id"),
            F.concat(F.lit("chat "), "rec_id").alias("label"),
            F.lit("").alias("source_file"),
            F.array_compact(
                F.array(
                    F.when(F.col("_systems") > 0, "has-system"),
                    F.when(F.col("_users") > 1, "multi-turn"),
                    F.when(F.col("_last") != "assistant", "unanswered-tail"),
                    F.concat(F.lit("turns-"), "_turns"),
                )
            ).alias("conventions_tested"),
            "prompt",
            "expected",
        )
    )


def predictions(recs: DataFrame) -> DataFrame:
    """Answers of three runs: a leading share of the reference, some marked, blank, failed or missing."""
    runs = F.array(*[F.struct(F.lit(r).alias("run_id"), F.lit(m).alias("model"), F.lit(s).cast("bigint").alias("shift")) for r, m, s in RUNS])
    turn = F.col("rec_id") + F.col("shift")
    words = F.split("expected", " ")
    share = F.floor((F.size(words) * (F.pmod(turn, F.lit(5)) + 1) + 4) / 5).cast("int")
    head = F.array_join(F.slice(words, F.lit(1), share), " ")
    failed = F.pmod(turn, F.lit(17)) == 0
    blank = F.pmod(turn, F.lit(19)) == 0
    marked = F.concat(head, F.when(F.pmod(turn, F.lit(3)) == 0, MARK).otherwise(""))
    return (
        recs.select("rec_id", "expected", F.explode(runs).alias("r"))
        .select("rec_id", "expected", "r.*")
        .filter(F.pmod(turn, F.lit(23)) != 0)
        .select(
            "run_id",
            "model",
            "rec_id",
            F.when(~failed & ~blank, marked).alias("generated"),
            F.when(failed, "timeout").alias("error"),
        )
    )


def answered(spark: SparkSession, sf: str) -> DataFrame:
    recs = records(spark, sf)
    return attach_predictions(recs, predictions(recs), RUN_IDS)


def results(spark: SparkSession, sf: str) -> DataFrame:
    return score_results(answered(spark, sf))


def results_of(spark: SparkSession, sf: str, *run_ids: str) -> DataFrame:
    return results(spark, sf).filter(F.col("run_id").isin(*run_ids))


RECORDS_SQL = """records AS (
  SELECT conv_id AS rec_id, conv_id AS ord, 'c' || (conv_id // 2) AS id, 'chat ' || conv_id AS label,
    list_filter([
      CASE WHEN count(*) FILTER (role = 'system') > 0 THEN 'has-system' END,
      CASE WHEN count(*) FILTER (role = 'user') > 1 THEN 'multi-turn' END,
      CASE WHEN arg_max(role, turn) <> 'assistant' THEN 'unanswered-tail' END,
      'turns-' || count(*)], lambda t: t IS NOT NULL) AS tags,
    arg_min(text, turn) FILTER (role = 'user') AS prompt,
    arg_min(text, turn) FILTER (role = 'assistant') AS expected
  FROM conversations GROUP BY conv_id)"""

_RUN_VALUES = ", ".join(f"('{r}', '{m}', {s})" for r, m, s in RUNS)
RESULTS_SQL = f"""{RECORDS_SQL},
words AS (
  SELECT r.*, u.run_id, u.model, u.shift, string_split(expected, ' ') AS toks
  FROM records r, (VALUES {_RUN_VALUES}) u(run_id, model, shift)),
heads AS (
  SELECT *, (rec_id + shift) % 3 = 0 AS marked, (rec_id + shift) % 19 = 0 AS blank,
    array_to_string(list_slice(toks, 1, (len(toks) * ((rec_id + shift) % 5 + 1) + 4) // 5), ' ') AS head,
    CASE WHEN expected IS NULL THEN 'no assistant turn' WHEN (rec_id + shift) % 23 = 0 THEN 'no prediction'
      WHEN (rec_id + shift) % 17 = 0 THEN 'timeout' WHEN prompt IS NULL THEN 'no user turn' END AS error
  FROM words),
texts AS (
  SELECT *, CASE WHEN blank THEN '' ELSE head || CASE WHEN marked THEN '{MARK}' ELSE '' END END AS answer FROM heads),
stripped AS (
  SELECT *, {q.strip('expected')} AS e, {q.strip('answer')} AS g, ltrim(head, {q.WS}) AS h FROM texts),
raws AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN blank THEN CASE WHEN length(e) = 0 THEN 1e0 ELSE 0e0 END
      ELSE 2e0 * least(length(e), CASE WHEN marked THEN length(h) ELSE length(g) END) / (length(e) + length(g)) END AS raw,
    length({q.strip_fences('answer')}) * 1e0 / greatest(length({q.strip_fences('expected')}), 1) AS ratio
  FROM stripped),
results AS (
  SELECT run_id, model, rec_id, ord, id, label, tags, error,
    CASE WHEN error IS NULL THEN {q.rounded('raw', 4)} ELSE 0e0 END AS score,
    CASE WHEN error IS NULL THEN {q.band('raw')} ELSE 'ERROR' END AS band,
    CASE WHEN error IS NULL THEN {q.rounded('ratio', 2)} ELSE 0e0 END AS length_ratio,
    CASE WHEN error IS NULL THEN prompt ELSE '' END AS prompt,
    CASE WHEN error IS NULL THEN expected ELSE '' END AS expected,
    CASE WHEN error IS NULL THEN answer ELSE '' END AS generated
  FROM raws)"""

SUMMARY_SQL = f"""summary AS (
  SELECT run_id, count(*) AS total, count(*) FILTER (band <> 'ERROR') AS n_scored, {q.band_counts()},
    CASE WHEN count(*) FILTER (band <> 'ERROR') = 0 THEN 0e0 ELSE
      {q.rounded("coalesce(CAST(sum(CAST(round(score*1e4) AS BIGINT)) FILTER (band <> 'ERROR') AS DOUBLE), 0e0) / (greatest(count(*) FILTER (band <> 'ERROR'), 1)*1e4)", 4)} END AS avg_score
  FROM results GROUP BY run_id)"""


def breakdown_sql(score: str = "score", source: str = "results", name: str = "breakdown") -> str:
    mean = f"CAST(sum(CAST(round({score}*1e4) AS BIGINT)) AS DOUBLE) / (count(*)*1e4)"
    return f"""{name} AS (
  SELECT run_id, convention, count(*) AS n, {q.rounded(mean, 3)} AS avg
  FROM (SELECT *, unnest(tags) AS convention FROM {source}) GROUP BY run_id, convention)"""


BREAKDOWN_SQL = breakdown_sql()


# ---------------------------------------------------------------- code-like answers

def code_like(text: Column, key: Column) -> Column:
    """Text dressed as code by rule: bare function, package header, fenced, imports only, plain."""
    rule = F.pmod(key, F.lit(5))
    return (
        F.when(rule == 0, F.concat(F.lit("func main() {\n"), text))
        .when(rule == 1, F.concat(F.lit("package main\n\n  func x() {\n"), text))
        .when(rule == 2, F.concat(F.lit("\n```go\nfunc a() {\n"), text, F.lit("\n}\n``` \n")))
        .when(rule == 3, F.concat(F.lit("// note\r\n import(\n"), text))
        .otherwise(F.concat(text, F.lit("\nfunc b() {}\nimport x")))
    )


def code_like_sql(text: str, key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 0 THEN 'func main() {{' || chr(10) || {text}"
        f" WHEN 1 THEN 'package main' || chr(10) || chr(10) || '  func x() {{' || chr(10) || {text}"
        f" WHEN 2 THEN chr(10) || '```go' || chr(10) || 'func a() {{' || chr(10) || {text} || chr(10) || '}}' || chr(10) || '``` ' || chr(10)"
        f" WHEN 3 THEN '// note' || chr(13) || chr(10) || ' import(' || chr(10) || {text}"
        f" ELSE {text} || chr(10) || 'func b() {{}}' || chr(10) || 'import x' END"
    )


# ---------------------------------------------------------------- API examples

def examples(spark: SparkSession, sf: str) -> DataFrame:
    """API examples, one per event: the endpoint is the event type, parameters go by rule."""
    k = F.get_json_object("props", "$.k")

    def obj(*pairs: tuple[str, str]) -> Column:
        parts = [F.concat(F.lit(f'"{name}": {quote}'), k, F.lit(quote)) for name, quote in pairs]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    size, token, item, status = ("pageSize", ""), ("pageToken", '"'), ("itemId", '"'), ("status", '"')
    rule = F.pmod("event_id", F.lit(7))
    params = (
        F.when(rule == 1, F.lit("{}"))
        .when(rule == 2, obj(size))
        .when(rule == 3, obj(size, token))
        .when(rule == 4, obj(token))
        .when(rule == 5, obj(item))
        .when(rule == 6, obj(item, status))
    )
    call = F.concat(
        F.lit('{"endpoint": "GET /v1/'), F.col("event_type"), F.lit('"'),
        F.when(params.isNull(), "").otherwise(F.concat(F.lit(', "params": '), params)), F.lit("}"),
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        F.col("event_type").alias("endpoint"),
        F.concat(F.lit("Show "), "event_type", F.lit(" "), k, F.lit(" of user "), "user_id").alias("question"),
        call.alias("api_call"),
    )


EXAMPLES_SQL = """examples AS (
  SELECT event_id AS key, event_type AS endpoint, k, params,
    'Show ' || event_type || ' ' || k || ' of user ' || user_id AS question,
    '{"endpoint": "GET /v1/' || event_type || '"' || CASE WHEN params IS NULL THEN '' ELSE ', "params": ' || params END || '}' AS api_call
  FROM (SELECT *, CASE event_id % 7 WHEN 1 THEN '{}' WHEN 2 THEN '{"pageSize": ' || k || '}'
      WHEN 3 THEN '{"pageSize": ' || k || ', "pageToken": "' || k || '"}' WHEN 4 THEN '{"pageToken": "' || k || '"}'
      WHEN 5 THEN '{"itemId": "' || k || '"}' WHEN 6 THEN '{"itemId": "' || k || '", "status": "' || k || '"}' END AS params
    FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)))"""

# The tags of the seven parameter rules, written out.
EXAMPLE_TAGS_SQL = """CASE key % 7 WHEN 0 THEN endpoint || ',no-params' WHEN 1 THEN endpoint || ',no-params'
    WHEN 2 THEN endpoint || ',page-size-only' WHEN 3 THEN endpoint || ',pagination,filtered'
    WHEN 4 THEN endpoint || ',pagination' WHEN 5 THEN endpoint || ',path-param'
    ELSE endpoint || ',filtered,path-param' END"""

# The pretty form of each example, written out.
EXAMPLE_BLOCK_SQL = """'```json' || chr(10) || '{' || chr(10) || '  "endpoint": "GET /v1/' || endpoint || '"' ||
    CASE key % 7 WHEN 0 THEN '' WHEN 1 THEN ',' || chr(10) || '  "params": {}'
      ELSE ',' || chr(10) || '  "params": {' || chr(10) || CASE key % 7
        WHEN 2 THEN '    "pageSize": ' || k
        WHEN 3 THEN '    "pageSize": ' || k || ',' || chr(10) || '    "pageToken": "' || k || '"'
        WHEN 4 THEN '    "pageToken": "' || k || '"'
        WHEN 5 THEN '    "itemId": "' || k || '"'
        ELSE '    "itemId": "' || k || '",' || chr(10) || '    "status": "' || k || '"' END || chr(10) || '  }' END
    || chr(10) || '}' || chr(10) || '```'"""


# ---------------------------------------------------------------- logs

def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(table(spark, sf, "events"))


def lines_of(events: DataFrame) -> DataFrame:
    """Trainer and run-log lines, one per event: the run is the user, order is the event id."""
    value, epoch = F.col("value").cast("string"), F.lpad(F.pmod("event_id", F.lit(100)).cast("string"), 2, "0")
    quote = F.when(F.col("event_type") == "view", "'").otherwise("")
    loss_line = F.concat(
        F.lit("{'loss': "), quote, value, quote, F.lit(", 'grad_norm': 1.5, 'epoch': "), quote, F.lit("0."), epoch, quote, F.lit("}")
    )
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{'train_loss': "), value, F.lit("}"))).otherwise(loss_line)
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("ord"),
        "ts",
        line.alias("line"),
        F.concat(
            F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] ["), F.upper("event_type"), F.lit("]   "), line
        ).alias("value"),
    )


LOG_LINES_SQL = """log_lines AS (
  SELECT *, '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] [' || upper(event_type) || ']   ' || line AS value FROM (
    SELECT user_id AS run, event_id AS ord, ts, event_type,
      CASE WHEN event_type = 'error' THEN '{''train_loss'': ' || value || '}'
        ELSE '{''loss'': ' || q || value || q || ', ''grad_norm'': 1.5, ''epoch'': ' || q || '0.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || q || '}' END AS line
    FROM (SELECT *, CASE WHEN event_type = 'view' THEN '''' ELSE '' END AS q FROM events)))"""

# The trainer's pattern as an SQL text.
_LOSS = "'" + LOSS_LINE.replace("'", "''") + "'"
POINTS_SQL = LOG_LINES_SQL + f""",
points AS (
  SELECT run, ord, TRY_CAST(regexp_extract(line, {_LOSS}, 2) AS DOUBLE) AS epoch, TRY_CAST(regexp_extract(line, {_LOSS}, 1) AS DOUBLE) AS loss
  FROM log_lines WHERE regexp_matches(line, {_LOSS}))"""


# ---------------------------------------------------------------- run histories

def history(spark: SparkSession, sf: str) -> DataFrame:
    """A run for every event, of many models over time; modification order differs from timestamp order.

    Every third event is a run of the base model, ``is_base``, all others are of models tuned from it.
    """
    base = F.pmod("event_id", F.lit(3)) == 0
    return table(spark, sf, "events").select(
        F.concat(F.lit("m"), "user_id").alias("base_model"),
        F.concat(F.lit("m"), "user_id", F.when(base, "").otherwise("-tuned")).alias("model"),
        F.col("event_id").alias("run_id"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("ts"),
        (F.col("event_id") + F.when(F.pmod("event_id", F.lit(2)) == 0, 500).otherwise(0)).alias("mtime"),
        base.alias("is_base"),
    )


HISTORY_SQL = """runs AS (SELECT 'm' || user_id AS base_model, 'm' || user_id || CASE WHEN event_id % 3 = 0 THEN '' ELSE '-tuned' END AS model,
    event_id AS run_id, date_trunc('minute', ts) AS ts, event_id + CASE WHEN event_id % 2 = 0 THEN 500 ELSE 0 END AS mtime, event_id % 3 = 0 AS is_base
  FROM events)"""
