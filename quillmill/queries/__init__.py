"""Registered queries: one per operator, over the given tables, with their SQL."""

from quillmill.queries import (  # noqa: F401  (imported for registration)
    batches,
    blocks,
    evaluation,
    runs,
    sources,
    splits,
    streams,
    tokens,
)
from quillmill.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
