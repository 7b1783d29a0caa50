"""All queries of this subpackage."""

from gradeloom.llm import (  # noqa: F401
    queries_audit,
    queries_chat,
    queries_dedup,
    queries_mixing,
    queries_quality,
    queries_search,
    queries_secrets,
    queries_sharding,
    queries_spelling,
    queries_tokens,
)
from gradeloom.llm.registry import ORACLES, QUERIES  # noqa: F401
