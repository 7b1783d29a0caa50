"""Answer metrics: ``(expected, generated) -> double`` between 0 and 1.

A metric is a function of two columns, or one over a table for what a row alone should not hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gradeloom.functions.text import py_strip

Metric = Callable[[Column, Column], Column]
#: ``(pairs, keys) -> scores``: from ``expected`` and ``generated`` per unique key to the keys and ``raw``.
TableMetric = Callable[[DataFrame, Sequence[str]], DataFrame]

TOKEN = r"[^\x20\x09-\x0D]+"


def _block_ratio(autojunk: bool):
    @F.pandas_udf(DoubleType())
    def ratio(expected: pd.Series, generated: pd.Series) -> pd.Series:
        seen = {(None, None): None}  # copies within a batch are scored once
        out = []
        for pair in zip(expected, generated):
            if pair not in seen:
                seen[pair] = SequenceMatcher(None, *pair, autojunk).ratio()
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return ratio


def char_ratio(expected: Column, generated: Column, autojunk: bool = True) -> Column:
    """Character similarity by longest matching blocks; the argument order matters.

    Where one text begins with the other (equal and truncated answers among them) the first
    block is the whole shorter text, so the ratio is plain arithmetic. Only the other pairs
    cross to Python, where stdlib ``difflib`` settles them.
    """
    a, b = py_strip(expected), py_strip(generated)
    la, lb = F.length(a), F.length(b)
    nested = F.startswith(a, b) | F.startswith(b, a)
    total = la + lb
    closed = F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * F.least(la, lb) / total)
    # Both texts or neither: ``nested`` is null where a text is.
    matched = _block_ratio(autojunk)(F.when(~nested, a), F.when(~nested, b))
    return F.when(nested, closed).otherwise(matched)


similarity = char_ratio


def levenshtein_ratio(expected: Column, generated: Column, least: float = 0.0) -> Column:
    """``1 - distance / length of the longer text`` by edits of single characters; two empty texts score 1.

    With ``least`` the distance is bounded: a pair whose ratio is below it scores 0, which is known from the lengths alone
    or once the bound is passed; ratios from ``least`` on are exact. Where one text begins with the other the distance is
    the difference in length, and nothing is aligned.
    """
    a, b = py_strip(expected), py_strip(generated)
    la, lb = F.length(a), F.length(b)
    longer, apart = F.greatest(la, lb), F.abs(la - lb)
    # The largest distance that still reaches the ratio; the margin takes in what doubles lose.
    bound = F.floor(F.lit(1.0 - least) * longer + F.lit(1e-9)).cast("int")
    nested = F.startswith(a, b) | F.startswith(b, a)
    # No text reaches the alignment that the length settles.
    aligned = F.call_function("levenshtein", F.when(~nested & (apart <= bound), a), b, bound)
    distance = F.when(nested, apart).when(apart > bound, F.lit(-1)).otherwise(aligned)
    ratio = F.when(longer == 0, F.lit(1.0)).when((distance < 0) | (distance > bound), F.lit(0.0)).otherwise(1.0 - distance / longer)
    return F.when(a.isNotNull() & b.isNotNull(), ratio)


def token_bag_dice(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys and ``raw``: twice the tokens both texts share, as multisets, over the tokens of both.

    Tokens are what white space separates. Every token becomes a row and is counted per key and token on both sides in one
    aggregation, which is combined before it is shuffled; long texts and frequent tokens are spread by it. Two texts without
    tokens score 1, a pair with a null text has no score.
    """
    names = [*keys]
    sides = F.array(
        *[F.struct(F.regexp_extract_all(F.col(c), F.lit(TOKEN), F.lit(0)).alias("tokens"), F.lit(i).alias("side")) for i, c in enumerate(("expected", "generated"))]
    )
    whole = pairs.filter(F.col("expected").isNotNull() & F.col("generated").isNotNull())
    # The outer explode keeps a pair without any token, as one null token on each side.
    tokens = whole.select(*names, F.inline(sides)).select(*names, "side", F.explode_outer("tokens").alias("token"))
    said = F.col("token").isNotNull()
    counted = tokens.groupBy(*names, "token").agg(*[F.count_if(said & (F.col("side") == i)).alias(s) for i, s in enumerate("ab")])
    shared, total = F.sum(F.least("a", "b")), F.sum(F.col("a") + F.col("b"))
    return counted.groupBy(*names).agg(F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * shared / total).alias("raw"))


_METRICS: dict[str, Metric] = {"char_ratio": char_ratio, "levenshtein_ratio": levenshtein_ratio}
_TABLE_METRICS: dict[str, TableMetric] = {"token_bag_dice": token_bag_dice}


def register_metric(name: str, fn: Metric) -> None:
    """Add a metric built from Column expressions or a pandas UDF."""
    _TABLE_METRICS.pop(name, None)
    _METRICS[name] = fn


def register_table_metric(name: str, fn: TableMetric) -> None:
    """Add a metric that works on a table of pairs, such as :func:`token_bag_dice`."""
    _METRICS.pop(name, None)
    _TABLE_METRICS[name] = fn


def metric(name: str | Metric) -> Metric:
    return name if callable(name) else _METRICS[name]


def table_metric(name: str | Metric) -> TableMetric | None:
    """The table metric of that name, if it is one."""
    return None if callable(name) else _TABLE_METRICS.get(name)
