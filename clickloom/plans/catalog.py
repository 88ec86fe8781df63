"""All registered queries; importing the modules registers them."""

from clickloom.plans import queries_basic, queries_extensions, queries_quality, queries_sessions, queries_streaming
from clickloom.plans.registry import COMPARISONS, QUERIES

__all__ = [
    "COMPARISONS",
    "QUERIES",
    "queries_basic",
    "queries_extensions",
    "queries_quality",
    "queries_sessions",
    "queries_streaming",
]
