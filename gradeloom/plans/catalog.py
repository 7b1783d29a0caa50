"""All registered queries."""

from gradeloom.plans import (  # noqa: F401
    queries_compare, queries_judge, queries_prepare, queries_scoring, queries_sources, queries_status, queries_streaming,
    queries_trainlog,
)
from gradeloom.plans.registry import ORACLES, QUERIES  # noqa: F401
