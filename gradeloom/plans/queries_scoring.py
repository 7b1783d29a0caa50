"""Scoring, aggregation and order queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gradeloom.functions import text as t
from gradeloom.functions.metrics import levenshtein_ratio, similarity
from gradeloom.operators import aggregate as agg
from gradeloom.operators import scoring
from gradeloom.plans import sqltext as q
from gradeloom.plans.registry import query
from gradeloom.plans.standins import (
    BREAKDOWN_SQL, MARK, RECORDS_SQL, RESULTS_SQL, SUMMARY_SQL, answered, code_like, code_like_sql, records, results, table,
)

R, B, S = q.ctes(RESULTS_SQL), q.ctes(RESULTS_SQL, BREAKDOWN_SQL), q.ctes(RESULTS_SQL, SUMMARY_SQL)
KEYS = ("run_id", "rec_id")


@query("strip_fences", f"""WITH d AS (SELECT doc_id, {code_like_sql('text', 'doc_id')} AS c FROM documents)
SELECT doc_id, md5({q.strip_fences('c')}) AS body, CAST(length({q.strip_fences('c')}) AS BIGINT) AS n FROM d""")
def _(spark, sf):
    body = t.strip_fences(code_like(F.col("text"), F.col("doc_id")))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(body).alias("body"), F.length(body).cast("bigint").alias("n")
    )


@query("py_strip", f"""SELECT doc_id, md5({q.strip("chr(160) || text || chr(12288) || chr(29)")}) AS body FROM documents""")
def _(spark, sf):
    padded = F.concat(F.lit(" "), F.col("text"), F.lit("　\u001d"))
    return table(spark, sf, "documents").select("doc_id", F.md5(t.py_strip(padded)).alias("body"))


@query("length_ratio", f"""WITH d AS (SELECT doc_id,
  length({q.strip_fences(code_like_sql('text', 'doc_id'))}) * 1e0 / greatest(length({q.strip_fences('text')}), 1) AS x FROM documents)
SELECT doc_id, {q.rounded('x', 2)} AS length_ratio FROM d""")
def _(spark, sf):
    c = code_like(F.col("text"), F.col("doc_id"))
    return table(spark, sf, "documents").select("doc_id", t.length_ratio(c, F.col("text")).alias("length_ratio"))


@query("format_flags", f"""WITH d AS (SELECT doc_id, {q.strip_fences(code_like_sql('text', 'doc_id'))} AS g FROM documents),
l AS (SELECT doc_id, g, list_transform(regexp_split_to_array(g, {q.LINES}), lambda x: {q.strip('x')}) AS ls FROM d),
p AS (SELECT *, list_position(list_transform(ls, lambda x: starts_with(x, 'func ')), true) AS pos FROM l),
b AS (SELECT *, CASE WHEN pos > 0 THEN list_slice(ls, 1, pos - 1) ELSE ls END AS pre FROM p)
SELECT doc_id, starts_with(g, 'func ') AS func_start,
  len(list_filter(pre, lambda x: starts_with(x, 'package ') OR starts_with(x, 'import ') OR starts_with(x, 'import('))) > 0 AS boilerplate
FROM b""")
def _(spark, sf):
    flags = t.format_flags(code_like(F.col("text"), F.col("doc_id")))
    return table(spark, sf, "documents").select("doc_id", flags.alias("f")).select("doc_id", "f.*")


@query("similarity", R + "SELECT run_id, rec_id, score FROM results WHERE error IS NULL")
def _(spark, sf):
    ok = answered(spark, sf).filter("error IS NULL")
    raw = ok.withColumn("raw", similarity(F.col("expected"), F.col("generated")))
    return raw.select(*KEYS, t.stored_score(F.col("raw")).alias("score"))


DICE = R + r"""p AS (SELECT run_id, rec_id, regexp_extract_all(expected, '[^\x20\x09-\x0D]+') AS a, regexp_extract_all(generated, '[^\x20\x09-\x0D]+') AS b
  FROM results WHERE error IS NULL),
t AS (SELECT run_id, rec_id, token, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM (
    SELECT run_id, rec_id, unnest(a) AS token, 0 AS side FROM p UNION ALL SELECT run_id, rec_id, unnest(b), 1 FROM p) GROUP BY ALL),
s AS (SELECT run_id, rec_id, sum(least(a, b)) AS shared FROM t GROUP BY ALL),
bags AS (SELECT p.run_id, p.rec_id, CASE WHEN len(a) + len(b) = 0 THEN 1e0 ELSE 2e0 * coalesce(shared, 0) / (len(a) + len(b)) END AS raw
  FROM p LEFT JOIN s USING (run_id, rec_id))
""".replace("p AS", ", p AS", 1) + f"SELECT run_id, rec_id, {q.rounded('raw', 4)} AS score, {q.band('raw')} AS band FROM bags"


@query("token_bag_dice", DICE)
def _(spark, sf):
    """All answers by the multiset overlap of their tokens."""
    return scoring.score_results(answered(spark, sf), by="token_bag_dice").filter("error IS NULL").select(*KEYS, "score", "band")


# An answer is a beginning of its reference, some with three foreign signs appended, so the distance has a closed form.
LEAST_RATIO = 0.4
EDITED = R + f""", d AS (SELECT run_id, rec_id, length(e) AS le, CASE WHEN blank THEN 0 WHEN marked THEN length(h) ELSE length(g) END AS lh,
    CASE WHEN marked AND NOT blank THEN {len(MARK)} ELSE 0 END AS added FROM raws WHERE error IS NULL),
n AS (SELECT *, greatest(le - lh, added) AS distance, greatest(le, lh + added) AS longer FROM d),
ratios AS (SELECT run_id, rec_id, CASE WHEN longer = 0 THEN 1e0 ELSE 1e0 - distance * 1e0 / longer END AS ratio FROM n),
raws2 AS (SELECT run_id, rec_id, CASE WHEN ratio >= {LEAST_RATIO}::DOUBLE - 1e-12 THEN ratio ELSE 0e0 END AS raw FROM ratios)
SELECT run_id, rec_id, {q.rounded('raw', 4)} AS score, {q.band('raw')} AS band FROM raws2"""


@query("levenshtein_ratio", EDITED)
def _(spark, sf):
    """All answers by bounded edit distance."""
    rated = scoring.score_results(answered(spark, sf), by=lambda a, b: levenshtein_ratio(a, b, LEAST_RATIO))
    return rated.filter("error IS NULL").select(*KEYS, "score", "band")


# The SQL counts bytes, so both sides see the texts with one plain sign for every other character.
@query("levenshtein_turns", f"""WITH t AS (SELECT conv_id, turn, {q.strip("regexp_replace(text, '[^ -~]', '?', 'g')")} AS a,
    {q.strip("regexp_replace(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '[^ -~]', '?', 'g')")} AS b FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1e0 ELSE 1e0 - levenshtein(a, b) * 1e0 / greatest(length(a), length(b)) END AS ratio
  FROM t WHERE b IS NOT NULL)
SELECT conv_id, turn, CASE WHEN ratio >= 25e-2 THEN ratio ELSE 0e0 END AS ratio FROM r""")
def _(spark, sf):
    """Every turn against the next one of its conversation: texts with nothing in common but their letters."""
    following = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text", following.alias("next")).filter("next IS NOT NULL")
    plain = [F.regexp_replace(c, "[^ -~]", "?") for c in ("text", "next")]
    return turns.select("conv_id", "turn", levenshtein_ratio(*plain, 0.25).alias("ratio"))


@query("similarity_turns")
def _(spark, sf):
    """Each reply against the turn before it: pairs of whole, unrelated texts."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("said"))
    # A broadcast would leave the pairs in as few tasks as the file has blocks.
    pairs = turns.join(before.hint("merge"), ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", similarity(F.col("said"), F.col("text")).alias("score"))


@query("band", f"SELECT event_id, {q.band('value / 100')} AS band FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", t.band(F.col("value") / 100).alias("band"))


@query("stored_score", f"WITH e AS (SELECT event_id, value / 730 AS x, value / 160 AS y FROM events) SELECT event_id, {q.rounded('x', 4)} AS score, {q.rounded('y', 4)} AS tied FROM e")
def _(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", t.stored_score(v / 730).alias("score"), t.stored_score(v / 160).alias("tied")
    )


@query("with_defaults", "WITH " + RECORDS_SQL + """
SELECT rec_id, CASE WHEN rec_id % 3 = 0 THEN CAST(rec_id AS VARCHAR) ELSE id END AS id,
  CASE WHEN rec_id % 2 = 0 THEN CASE WHEN rec_id % 3 = 0 THEN CAST(rec_id AS VARCHAR) ELSE id END ELSE label END AS label,
  CASE WHEN rec_id % 5 = 0 THEN '' ELSE array_to_string(tags, ',') END AS tags, '' AS source_file FROM records""")
def _(spark, sf):
    k = F.col("rec_id")
    sparse = records(spark, sf).withColumns(
        {
            "id": F.when(k % 3 != 0, F.col("id")),
            "label": F.when(k % 2 != 0, F.col("label")),
            "conventions_tested": F.when(k % 5 != 0, F.col("conventions_tested")),
            "source_file": F.lit(None).cast("string"),
        }
    )
    return scoring.with_defaults(sparse, "ord").select(
        "rec_id", "id", "label", F.array_join("conventions_tested", ",").alias("tags"), "source_file"
    )


@query("attach_predictions", R + """SELECT run_id, rec_id, error,
  CASE WHEN error IS NULL THEN md5(generated) END AS answer FROM results""")
def _(spark, sf):
    return answered(spark, sf).select(
        *KEYS, "error", F.when(F.col("error").isNull(), F.md5("generated")).alias("answer")
    )


@query("error_row", R + "SELECT run_id, rec_id, label, score, band, prompt, expected, generated, length_ratio, error FROM results WHERE band = 'ERROR'")
def _(spark, sf):
    bad = results(spark, sf).filter(F.col("band") == t.ERROR_BAND)
    return bad.select(*KEYS, "label", "score", "band", "prompt", "expected", "generated", "length_ratio", "error")


@query("score_results", R + """SELECT run_id, rec_id, id, label, array_to_string(tags, ',') AS tags, score, band, length_ratio, error,
  md5(prompt) AS prompt, md5(expected) AS expected, md5(generated) AS generated FROM results""")
def _(spark, sf):
    return results(spark, sf).select(
        *KEYS, "id", "label", F.array_join("conventions_tested", ",").alias("tags"), "score", "band", "length_ratio", "error",
        *[F.md5(c).alias(c) for c in ("prompt", "expected", "generated")],
    )


@query("scored_only", R + "SELECT run_id, rec_id, score FROM results WHERE band <> 'ERROR'")
def _(spark, sf):
    return agg.scored_only(results(spark, sf)).select(*KEYS, "score")


@query("failing_examples", R + "SELECT run_id, rec_id, band, score FROM results WHERE band IN ('POOR', 'PARTIAL', 'ERROR') ORDER BY run_id, ord")
def _(spark, sf):
    return agg.failing_examples(results(spark, sf)).select(*KEYS, "band", "score")


@query("run_average", S + "SELECT run_id, n_scored, avg_score FROM summary")
def _(spark, sf):
    return agg.run_average(results(spark, sf))


@query("band_counts", S + "SELECT run_id, excellent, good, partial, poor, error FROM summary")
def _(spark, sf):
    return agg.band_counts(results(spark, sf))


@query("run_summary", S + "SELECT * FROM summary")
def _(spark, sf):
    return agg.run_summary(results(spark, sf))


@query("tag_scores", R + "SELECT run_id, unnest(tags) AS convention, ord, score FROM results")
def _(spark, sf):
    return agg.tag_scores(results(spark, sf))


@query("tag_breakdown", B + "SELECT * FROM breakdown")
def _(spark, sf):
    return agg.tag_breakdown(results(spark, sf))


@query("tested_tags", B + "SELECT DISTINCT run_id, convention FROM breakdown")
def _(spark, sf):
    return agg.tested_tags(agg.tag_breakdown(results(spark, sf)))


@query("weak_tags", B + "SELECT run_id, convention, avg, n, " + q.band("avg") + " AS band FROM breakdown WHERE avg < CAST(0.6 AS DOUBLE) ORDER BY run_id, avg, convention")
def _(spark, sf):
    return agg.worst_tags(agg.weak_tags(agg.tag_breakdown(results(spark, sf))))


@query("worst_tags", B + "SELECT run_id, convention, avg, n, " + q.band("avg") + " AS band FROM breakdown ORDER BY run_id, avg, convention")
def _(spark, sf):
    return agg.worst_tags(agg.tag_breakdown(results(spark, sf)))


@query("worst_examples", R + "SELECT run_id, rec_id, score FROM results ORDER BY run_id, score, ord")
def _(spark, sf):
    return agg.worst_examples(results(spark, sf)).select(*KEYS, "score")


@query("top_weak_tags", B + """SELECT * FROM (SELECT run_id, convention, avg, n,
  row_number() OVER (PARTITION BY run_id ORDER BY avg, convention) AS rank FROM breakdown WHERE avg < CAST(0.6 AS DOUBLE)) WHERE rank <= 5""")
def _(spark, sf):
    return agg.top_weak_tags(agg.tag_breakdown(results(spark, sf))).withColumn("rank", F.col("rank").cast("bigint"))


CODE = q.ctes(RESULTS_SQL, f"""coded AS (SELECT run_id, ord, label, score, length_ratio,
  {q.strip_fences(code_like_sql('generated', 'rec_id'))} AS g FROM results WHERE band <> 'ERROR')""",
    f"lined AS (SELECT *, list_transform(regexp_split_to_array(g, {q.LINES}), lambda x: {q.strip('x')}) AS ls FROM coded)",
    "placed AS (SELECT *, list_position(list_transform(ls, lambda x: starts_with(x, 'func ')), true) AS pos FROM lined)",
    """flagged AS (SELECT *, starts_with(g, 'func ') AS func_start, len(list_filter(
  CASE WHEN pos > 0 THEN list_slice(ls, 1, pos - 1) ELSE ls END,
  lambda x: starts_with(x, 'package ') OR starts_with(x, 'import ') OR starts_with(x, 'import('))) > 0 AS boilerplate FROM placed)""")


def coded(spark, sf):
    return results(spark, sf).withColumn("generated", code_like(F.col("generated"), F.col("rec_id")))


@query("format_health", CODE + f"""SELECT run_id, {q.rounded('100e0 * count(*) FILTER (func_start) / greatest(count(*), 1)', 1)} AS func_start_pct,
  count(*) FILTER (boilerplate) AS boilerplate_detected FROM flagged GROUP BY run_id""")
def _(spark, sf):
    return agg.format_health(coded(spark, sf))


@query("boilerplate_cases", CODE + f"SELECT run_id, ord, label AS func, {q.rounded('score', 3)} AS score, length_ratio FROM flagged WHERE boilerplate")
def _(spark, sf):
    return agg.boilerplate_cases(coded(spark, sf))


@query("score_bar", f"""WITH e AS (SELECT event_id, (event_id % 101) / 1e2 AS s FROM events)
SELECT event_id, '[' || repeat('█', CAST(floor(s * 30) AS INT)) || repeat('·', 30 - CAST(floor(s * 30) AS INT)) || '] ' || {q.two_digits('s')} AS bar FROM e""")
def _(spark, sf):
    s = (F.col("event_id") % 101) / 100.0
    return table(spark, sf, "events").select("event_id", t.score_bar(s).alias("bar"))


@query("prompt_stats", "SELECT doc_id, length(text) AS chars, length(text) // 4 AS est_tokens FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.prompt_stats(F.col("text")).alias("s")).select("doc_id", "s.*")
