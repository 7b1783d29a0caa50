"""Keeping costly expressions from being evaluated more than once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """Names for working columns that none of ``columns`` has, whatever its case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns whose later use in a filter does not repeat the expression.

    The optimizer moves a filter below the projection it reads from by copying the
    projected expressions into it, so a filter on a parsed or scored column would parse or
    score twice. A generator producing one row per row stops that for its own columns,
    while filters on all other columns still move below it.
    """
    made = F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    return df.select(*kept, made)
