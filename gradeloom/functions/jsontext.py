"""JSON text taken as a whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's parsers stop at the end of the first value. Read as the first of two elements of a list, the text has to end
# where its value ends, or the second element is not this one.
END = "\x01end"


def whole_json(text: Column) -> Column:
    """The text's JSON value as a variant; null if it is not one value and nothing else.

    The parsed pair is bound to a name, so that looking into it three times does not parse three times.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"\\u0001end"]')))

    def value_of(pair: Column) -> Column:
        ends = (F.try_variant_get(pair, "$[1]", "string") == END) & F.try_variant_get(pair, "$[2]", "variant").isNull()
        return F.when(ends, F.try_variant_get(pair, "$[0]", "variant"))

    return F.get(F.transform(F.array(pair), value_of), F.lit(0))


def has_keys(value: Column, *keys: str) -> Column:
    """Whether a variant is an object with all the keys."""
    found = F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))
    for key in keys:
        found = found & F.try_variant_get(value, f"$.{key}", "variant").isNotNull()
    return F.coalesce(found, F.lit(False))
