"""Decisions over scores, deltas, losses and sizes, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions.text import STRONG_SCORE, WEAK_SCORE

# Thresholds of the decisions below.
MEANINGFUL_DELTA = 0.05
UNDERTRAINED = 0.35
UNDERFIT_RECORDS, FEW_RECORDS = 100, 500
NOT_CONVERGED_LOSS, OVERFIT_LOSS = 1.0, 0.15
WARNING_EPOCH, WARNING_LOSS = 0.2, 1.5
TARGET_LOSS = 0.6
CANARY_STEPS = 300
AUTO_EPOCHS = 4
PRIORITIES = ("critical", "high", "medium", "low")

# Plan tiers as (records below, batch, accumulation, epochs, least steps).
PLAN_TIERS = ((32, 2, 1, 12, 96), (96, 4, 1, 12, 96), (None, 8, 2, 10, 80))
PLAN_SAVE_RANGE = (25, 100)
# The settings every plan shares.
PLAN_CONSTANTS = {
    "max_seq_length": 512,
    "lora_rank": 16,
    "lora_alpha": 32,
    "lora_dropout": 0,
    "warmup_steps": 20,
    "learning_rate": 2.0e-4,
    "weight_decay": 0.01,
    "lr_scheduler": "cosine",
}


def grade_records(n: Column) -> Column:
    """How far a training set of ``n`` records carries."""
    return F.when(n < UNDERFIT_RECORDS, "likely underfit").when(n < FEW_RECORDS, "consider more").otherwise("ok")


def boost_priority(avg: Column, n: Column) -> Column:
    """Urgency of more data for a weak tag."""
    return (
        F.when((n >= 10) & (avg < 0.5), "critical")
        .when(avg < 0.3, "high")
        .when(avg < 0.5, "medium")
        .otherwise("low")
    )


def priority_rank(priority: Column) -> Column:
    return F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), priority) - 1


def skip_reason(avg: Column) -> Column:
    return F.when(avg >= STRONG_SCORE, "EXCELLENT").otherwise("GOOD")


def next_action(n_boost: Column, avg: Column) -> Column:
    return (
        F.when(n_boost > 0, "GENERATE_DATA")
        .when(avg < WEAK_SCORE, "TRAIN")
        .when(avg >= STRONG_SCORE, "DONE")
        .otherwise("EVAL")
    )


def delta_verdict(tuned: Column, base: Column) -> Column:
    """Effect of tuning, strict on both sides of the meaningful delta."""
    delta = tuned - base
    return (
        F.when(delta.isNull(), F.lit(None).cast("string"))
        .when(delta > MEANINGFUL_DELTA, "helping")
        .when(delta < -MEANINGFUL_DELTA, "hurting")
        .otherwise("minimal effect")
    )


def diagnosis(tuned: Column, base: Column | None = None) -> Column:
    """What the averages say about the training; ``base`` may be null or left out."""
    base = F.lit(None).cast("double") if base is None else base
    return (
        F.when(tuned.isNull(), F.lit(None).cast("string"))
        .when(base.isNotNull() & (tuned < base - MEANINGFUL_DELTA), "hurting")
        .when(base.isNotNull() & (tuned - base < MEANINGFUL_DELTA), "no effect")
        .when(tuned < UNDERTRAINED, "undertrained")
        .when(tuned < WEAK_SCORE, "working")
        .otherwise("good")
    )


def is_strong(avg: Column) -> Column:
    return avg >= STRONG_SCORE


def loss_health(final_loss: Column) -> Column:
    return (
        F.when(final_loss > NOT_CONVERGED_LOSS, "not converged")
        .when(final_loss < OVERFIT_LOSS, "overfit")
        .otherwise("ok")
    )


def _steps_per_epoch(n: Column, eff_batch: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / eff_batch))


def auto_steps(n: Column, eff_batch: Column, epochs: int = AUTO_EPOCHS) -> Column:
    """Steps for a number of epochs over ``n`` records."""
    return F.greatest(F.lit(1), F.lit(epochs) * _steps_per_epoch(n, eff_batch)).cast("bigint")


def resolve_steps(cli: Column, canary: Column, manifest: Column, auto: Column, default: Column) -> Column:
    """Step count by precedence, the source it came from, and whether it was resolved explicitly."""
    explicit = F.when(canary, F.lit(CANARY_STEPS)).otherwise(cli)
    return F.struct(
        F.coalesce(explicit, manifest, auto, default).cast("bigint").alias("steps"),
        F.when(canary, "canary")
        .when(cli.isNotNull(), "steps")
        .when(manifest.isNotNull(), "manifest")
        .when(auto.isNotNull(), "auto")
        .otherwise("default")
        .alias("step_source"),
    )


def epochs_of(steps: Column, n: Column, eff_batch: Column) -> Column:
    return steps / _steps_per_epoch(n, eff_batch)


def step_estimate(first: Column, last: Column, points: Column, steps: Column, target: float = TARGET_LOSS) -> Column:
    """Steps a canary run suggests for reaching the target loss.

    Null unless a step count was resolved and at least three points were logged. The
    suggestion moves up by a whole hundred even from an exact multiple.
    """
    drop = first - last
    rate = drop / steps
    extra = F.when((drop > 0) & (last > target), ((last - target) / rate).cast("bigint"))
    verdict = F.when(extra.isNotNull(), "estimate").when(drop > 0, "may be sufficient").otherwise("did not decrease")
    usable = steps.isNotNull() & (points >= 3)
    return F.when(
        usable,
        F.struct(
            verdict.alias("verdict"),
            F.when(extra.isNotNull(), rate).alias("rate"),
            extra.alias("extra_steps"),
            (steps + extra).cast("bigint").alias("total_steps"),
            (((steps + extra) * F.lit(1.2) / 100 + 1).cast("bigint") * 100).alias("suggested_steps"),
        ),
    )


def plan_columns(n: Column) -> dict[str, Column]:
    """Training settings for ``n`` training records."""

    def tier(field: int) -> Column:
        chain = None
        for row in PLAN_TIERS[:-1]:
            chain = F.when(n < row[0], row[field]) if chain is None else chain.when(n < row[0], row[field])
        return chain.otherwise(PLAN_TIERS[-1][field]).cast("bigint")

    batch, accumulation, epochs, least = (tier(i) for i in range(1, 5))
    per_epoch = F.greatest(F.lit(1), F.ceil(n / (batch * accumulation)))
    max_steps = F.greatest(least, epochs * per_epoch).cast("bigint")
    low, high = PLAN_SAVE_RANGE
    save_steps = F.greatest(F.lit(low), F.least(F.lit(high), F.floor(max_steps / 4))).cast("bigint")
    return {
        "batch_size": batch,
        "gradient_accumulation_steps": accumulation,
        "max_steps": max_steps,
        "save_steps": save_steps,
    }
