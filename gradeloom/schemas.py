"""Explicit schemas of every source; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


STRING, LONG, INT, DOUBLE = StringType(), LongType(), IntegerType(), DoubleType()
STRINGS = ArrayType(STRING)

# Free-form ``params`` stay JSON text.
API_EXAMPLE = _struct(question=STRING, api_call=STRING)

SHAREGPT = StructType(
    [
        StructField(
            "conversations",
            ArrayType(StructType([StructField("from", STRING), StructField("value", STRING)])),
        )
    ]
)

MESSAGES = ArrayType(_struct(role=STRING, content=STRING))
HOLDOUT = _struct(id=STRING, label=STRING, messages=MESSAGES, conventions_tested=STRINGS, source_file=STRING)

PREDICTION = _struct(run_id=STRING, model=STRING, rec_id=LONG, id=STRING, generated=STRING, error=STRING)

JUDGE_RESPONSE = _struct(run_id=STRING, rec_id=LONG, response=STRING, failure=STRING)

RESULT = _struct(
    id=STRING, label=STRING, source_file=STRING, conventions_tested=STRINGS, score=DOUBLE, band=STRING,
    prompt=STRING, expected=STRING, generated=STRING, error=STRING, length_ratio=DOUBLE,
    judge_score=DOUBLE, judge_band=STRING, judge_reason=STRING,
)
TAG_ROW = _struct(convention=STRING, avg=DOUBLE, n=LONG, scores=ArrayType(DOUBLE))
RUN_META = _struct(
    timestamp=STRING, model=STRING, base_url=STRING, holdout_file=STRING, n_records=INT,
    base_model=STRING, lora_path=STRING, system_prompt_source=STRING, system_prompt_chars=INT,
    judge_model=STRING, scored_at=STRING,
)
SUMMARY = _struct(
    avg_score=DOUBLE, band_counts=MapType(STRING, LONG),
    convention_breakdown=ArrayType(TAG_ROW), weak_conventions=ArrayType(TAG_ROW),
)
RUN = _struct(meta=RUN_META, summary=SUMMARY, similarity_summary=SUMMARY, results=ArrayType(RESULT))

_PATTERNS = ArrayType(_struct(tags=STRINGS))
MANIFEST = _struct(
    meta=_struct(cycle=INT, max_steps=STRING),
    patterns=_PATTERNS,
    training=_struct(contrast_patterns=_PATTERNS, patterns=_PATTERNS),
)

# The stored table of results, as written per run.
RUN_RESULTS = StructType(
    [
        StructField("run_id", STRING),
        StructField("model", STRING),
        StructField("rec_id", LONG),
        StructField("ord", LONG),
        StructField("score_bp", LONG),
        *RESULT.fields,
    ]
)
