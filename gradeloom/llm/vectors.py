"""What the vector operators share: which vectors take part, and in which form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(vector: Column) -> Column:
    """Whether a vector is not null and holds no null and no infinite or missing number."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector can be compared."""
    return rows.filter(is_usable(F.col(vector)))
