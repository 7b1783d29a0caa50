import json

import pytest
from pyspark.sql import functions as F

from conftest import FAILED, SF
from gradeloom.functions import chat
from gradeloom.operators import prepare, split, validate
from gradeloom.plans import queries_prepare, skew
from gradeloom.plans.skew import bucketed_rank, shuffle_hash
from gradeloom.sources import readers, sinks


def example(question, call):
    return {"question": question, "api_call": call}


TAG_CASES = [
    ({"pageSize": 10}, ["items", "page-size-only"]),
    ({"pageSize": 10, "pageToken": "x"}, ["items", "pagination", "filtered"]),
    ({"pageToken": "x"}, ["items", "pagination"]),
    ({"status": "on"}, ["items"]),
    ({"itemId": "7"}, ["items", "path-param"]),
    ({"itemId": "7", "status": "on"}, ["items", "filtered", "path-param"]),
    ({"pageSize": 1, "itemId": "7"}, ["items", "filtered", "path-param"]),
    ({}, ["items", "no-params"]),
    (None, ["items", "no-params"]),
]


def call(params):
    return {"endpoint": "GET /v1/items"} | ({} if params is None else {"params": params})


def calls(spark, items):
    return spark.createDataFrame([(i, "items", json.dumps(c)) for i, c in enumerate(items)], "key int, endpoint string, api_call string")


def test_tags(spark):
    df = prepare.with_params(calls(spark, [call(p) for p, _ in TAG_CASES]))
    got = df.select("key", chat.derive_tags(F.col("endpoint"), F.col("params")).alias("t")).orderBy("key").collect()
    assert [r.t for r in got] == [tags for _, tags in TAG_CASES]


def test_null_params(spark):
    df = calls(spark, [{"endpoint": "x", "params": None}, call({})])
    rows = prepare.with_params(df, strict=False).orderBy("key").collect()
    assert [r.params_error for r in rows] == ["params is null", None]
    with pytest.raises(FAILED):
        prepare.with_params(df).collect()


def test_render_matches_json_dumps(spark):
    values = [call({"b": 1.50, "a": ["é", None, True], "n": {}}), call(None), call({"x": []})]
    rows = calls(spark, values).select("key", chat.render_json_block(F.col("api_call")).alias("b")).orderBy("key").collect()
    assert [r.b for r in rows] == ["```json\n" + json.dumps(v, indent=2) + "\n```" for v in values]


@pytest.mark.parametrize("n,held", [(1, 1), (4, 1), (15, 2), (25, 2), (35, 4)])
def test_split_sizes(spark, n, held):
    df = spark.range(n).withColumn("s", F.lit("a"))
    assert split.stratified_split(df, "s", "id").filter("split = 'holdout'").count() == held


def test_split_is_whole_disjoint_and_independent_of_partitions(spark):
    df = spark.range(3000).withColumn("s", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, F.concat(F.lit("s"), F.col("id") % 30)))
    one, many = (
        {(r.id, r.s, r.split) for r in split.stratified_split(df.repartition(n), "s", "id", digits=d).collect()}
        for n, d in ((1, 1), (13, 4))
    )
    assert one == many and len(one) == 3000
    assert sorted(i for i, *_ in one) == list(range(3000))
    sizes = {}
    for _, s, part in one:
        sizes.setdefault(s, []).append(part)
    for parts in sizes.values():
        assert parts.count("holdout") == max(1, round(len(parts) * 0.1))


def test_split_seed_changes_membership(spark):
    df = spark.range(500).withColumn("s", F.lit("a"))
    a, b = ({r.id for r in split.stratified_split(df, "s", "id", seed=s).filter("split = 'holdout'").collect()} for s in (1, 2))
    assert len(a) == len(b) == 50 and a != b


def test_holdout_ids_count_from_zero_per_endpoint(spark):
    df = spark.range(10_050).select(F.col("id").alias("key"), F.when(F.col("id") < 10_020, "a").otherwise("b").alias("endpoint"))
    ids = {r.id for r in prepare.holdout_ids(df).collect()}
    assert ids == {f"a-{i:04d}" for i in range(10_020)} | {f"b-{i:04d}" for i in range(30)}


def test_ranks_do_not_depend_on_bucket_size(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").alias("g"))
    df = df.withColumn("h", shuffle_hash(F.col("k"), 1))
    one, many = ({(r.k, r.n) for r in bucketed_rank(df, "g", "h", "k", "n", rows).collect()} for rows in (10_000, 20))
    assert one == many and sorted(n for _, n in one) == sorted([*range(2000), *range(1000)])


def test_lookup_join_is_the_same_salted_and_broadcast(spark, monkeypatch):
    big = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 10).alias("g"))
    small = spark.range(8).select(F.col("id").alias("g"), (F.col("id") * 2).alias("v"))
    out = []
    for limit in (10, 0):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
        for how in ("inner", "left"):
            out.append({(r.k, r.v) for r in skew.lookup_join(big, small, ["g"], ["k"], how).collect()})
    assert out[0] == out[2] and out[1] == out[3] and len(out[1]) == 1000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_pieces_follow_the_counts(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 20)
    big = spark.range(1_000).select(F.col("id").alias("k"), F.when(F.col("id") < 600, "hot").when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"), F.lit(1).alias("h"))
    small = big.filter("g IS NOT NULL").select("g", "h").distinct().withColumn("v", F.concat("g", F.lit("!")))
    want = {(r.k, r.g and r.g + "!") for r in big.collect() if how == "left" or r.g}
    for hot in (10_000, 70, 7):
        rows = skew.counted_join(big, small, ["g", "h"], ["k"], how, hot).collect()
        assert len(rows) == len(want) and {(r.k, r.v) for r in rows} == want
    # One hot key of 600 rows makes 9 pieces of about 70; no other row of the small side is repeated.
    plan = skew.counted_join(big, small, ["g", "h"], ["k"], how, 70)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(0" in plan


def test_hot_key_join_keeps_every_row(spark):
    big = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"))
    other = spark.range(2900).select(F.col("id").alias("g"), (F.col("id") + 1).alias("v"))
    plain = {tuple(r) for r in big.join(other, "g").select("k", "v").collect()}
    for hot in (10, 100_000):
        rows = skew.hot_key_join(big, other, "g", ["k"], hot).select("k", "v").collect()
        assert len(rows) == len(plain) and {tuple(r) for r in rows} == plain


@pytest.mark.parametrize(
    "n,plan", [(31, (2, 1, 192, 48)), (32, (4, 1, 96, 25)), (95, (4, 1, 288, 72)), (96, (8, 2, 80, 25)), (1324, (8, 2, 830, 100))]
)
def test_training_plan(spark, n, plan):
    counts = spark.createDataFrame([("e", n, 1)], "endpoint string, n_train bigint, n_holdout bigint")
    row = split.training_plan(counts).first()
    assert (row.batch_size, row.gradient_accumulation_steps, row.max_steps, row.save_steps) == plan


VALIDATION = [
    ('{"conversations": [{"from": "human", "value": "x"}]}', None),
    ("{bad", "not valid JSON"),
    ("", None),
    ('{"messages": []}', "no conversations key"),
    ('{"conversations": []}', "conversations is not a non-empty list"),
    ('{"conversations": "x"}', "conversations is not a non-empty list"),
    ('{"conversations": {"from": 1}}', "conversations is not a non-empty list"),
    ('{"conversations": [{"role": "user"}]}', "first turn lacks from or value"),
    ('{"conversations": ["x"]}', "first turn lacks from or value"),
    ('{"conversations": [{"from": null, "value": null}]}', None),
    ("[1]", "record is not an object"),
    ("3", "record is not an object"),
]


def test_validation(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("\n".join(line for line, _ in VALIDATION) + "\n")
    lines = validate.with_ordinal(readers.read_lines(spark, str(tmp_path / "t.jsonl")))
    got = {(r.line_no, r.reason) for r in validate.validate_sharegpt(lines).collect()}
    assert got == {(i, reason) for i, (_, reason) in enumerate(VALIDATION, 1) if reason}
    first = validate.validate_sharegpt(lines, first_n=3).collect()
    assert [(r.line_no, r.record_no) for r in first] == [(2, 2), (4, 3)]


def test_faulty_lines_hold_whole_texts(spark):
    lines = queries_prepare.sharegpt_lines(spark, SF).select("line_no", "value")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    values = {r.line_no - 1: r.value for r in lines.collect()}
    assert values.keys() == texts.keys()
    for doc, value in values.items():
        if doc % 8 == 6:  # blank lines are no records
            assert not value.strip()
        elif doc % 8 == 1:
            with pytest.raises(ValueError):
                json.loads(value)
            assert json.loads(value.removesuffix(" bad") + "}")["text"] == texts[doc]
        else:
            said = json.loads(value)
            held = {0: lambda x: x["conversations"][0]["value"], 4: lambda x: x["conversations"], 5: lambda x: x["conversations"][0]["text"], 7: lambda x: x[1]["text"]}
            assert held.get(doc % 8, lambda x: x["text"])(said) == texts[doc]


def test_ordinals_across_blocks_of_one_file(spark, tmp_path):
    lines = [("" if i % 7 == 0 else f"row {i}") for i in range(1, 5001)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "small.txt").write_text("x\n\ny\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = validate.with_ordinal(readers.read_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    big = sorted((r.line_no, r.record_no, r.value) for r in rows if r.path.endswith("big.txt"))
    kept = [(i, line) for i, line in enumerate(lines, 1) if line]
    assert big == [(no, rec, line) for rec, (no, line) in enumerate(kept, 1)]
    assert sorted((r.line_no, r.record_no) for r in rows if r.path.endswith("small.txt")) == [(1, 1), (3, 2)]


@pytest.mark.parametrize("n,grade", [(99, "likely underfit"), (100, "consider more"), (499, "consider more"), (500, "ok")])
def test_grade(spark, n, grade):
    assert validate.grade_size(spark.range(n)).first().grade == grade


def write_examples(root, endpoint, lines):
    folder = root / endpoint
    folder.mkdir(parents=True)
    (folder / "training.jsonl").write_text("\n".join(lines))


def test_read_examples(spark, tmp_path):
    write_examples(tmp_path, "items", [json.dumps(example("q1", call({"b": 1, "a": 2}))), "  ", json.dumps(example("q2", call(None)))])
    write_examples(tmp_path, "empty", [])
    rows = readers.read_examples(spark, str(tmp_path)).orderBy("question").collect()
    assert [(r.endpoint, r.question) for r in rows] == [("items", "q1"), ("items", "q2")]
    assert list(json.loads(rows[0].api_call)["params"]) == ["b", "a"]
    numbered = readers.read_examples(spark, str(tmp_path), ordinal=True).orderBy("question").collect()
    assert [(r.question, r.line_no) for r in numbered] == [("q1", 1), ("q2", 3)]


def test_read_examples_malformed(spark, tmp_path):
    write_examples(tmp_path, "items", [json.dumps(example("q1", call({}))), "{bad"])
    with pytest.raises(FAILED):
        readers.read_examples(spark, str(tmp_path)).collect()
    rows = readers.read_examples(spark, str(tmp_path), mode="quarantine").collect()
    assert sorted(str(r.malformed) for r in rows) == ["None", "{bad"]


def test_read_holdout_blank_line_raises(spark, tmp_path):
    record = json.dumps({"messages": [{"role": "user", "content": "x"}]})
    (tmp_path / "ok.jsonl").write_text(record + "\n" + record + "\n")
    (tmp_path / "blank.jsonl").write_text(record + "\n\n" + record + "\n")
    rows = readers.read_holdout(spark, str(tmp_path / "ok.jsonl"), ordinal=True).collect()
    assert sorted(r.ord for r in rows) == [0, 1] and rows[0].messages[0].content == "x"
    with pytest.raises(FAILED):
        readers.read_holdout(spark, str(tmp_path / "blank.jsonl")).collect()


def test_sync_missing_endpoint(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "endpoint string, x int")
    with pytest.raises(FileNotFoundError, match="c"):
        sinks.sync_endpoints(df, str(tmp_path / "s"), ["a", "c"])
    sinks.sync_endpoints(df, str(tmp_path / "s"))
    sinks.sync_endpoints(df.withColumn("x", F.col("x") + 10), str(tmp_path / "s"), ["b"])
    assert {(r.endpoint, r.x) for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {("a", 1), ("b", 12)}


def test_resolve_dataset():
    assert readers.resolve_dataset("/d", "v1") == ("/d/training_v1.jsonl", "/d/holdout_v1.jsonl")
    assert readers.resolve_dataset("/d/", None, "/x.jsonl") == ("/d/training.jsonl", "/x.jsonl")


def test_select_endpoints(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "endpoint string")
    assert [r.endpoint for r in prepare.select_endpoints(df, ["c", "a"]).collect()] == ["c", "a"]
    assert [r.endpoint for r in prepare.select_endpoints(df.union(df)).collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        prepare.select_endpoints(df.filter("false"))


@pytest.mark.parametrize("rows", [200_000, 0])
def test_holdout_rows_are_the_split_and_its_order(spark, monkeypatch, rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", rows)
    data = [(f"k{i}", ["a", "b", None, "c"][0 if i < 300 else i % 4], i) for i in range(700)] + [("single", "d", 1)]
    df = spark.createDataFrame(data, "key string, endpoint string, _prefix int")
    parts = split.stratified_split(df, "endpoint", "key").filter("split = 'holdout'").drop("split")
    want = {(r.key, r.endpoint, r._prefix, None if r.endpoint is None else r.id) for r in prepare.holdout_ids(parts).collect()}
    held = split.holdout_rows(df, "endpoint", "key", digits=1)
    got = {(r.key, r.endpoint, r._prefix, None if r.endpoint is None else r.id) for r in prepare.holdout_ids(held, rank="split_rank").collect()}
    assert got == want and len(want) > 60
    assert sorted(r.split_rank for r in held.filter("endpoint IS NULL").collect()) == list(range(sum(w[1] is None for w in want)))


def test_holdout_is_read_whole_once(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    text = split.holdout_rows(df, "event_type", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert text.count("events.parquet") == 1 and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
