"""Operators for preparing training text, their registered queries and SQL.

Nothing else in the library imports this subpackage.
"""

from quillmill.llm import (  # noqa: F401  (imported for registration)
    classifier,
    fingerprints,
    jaccard,
    licences,
    lines,
    merkle,
    mixing,
    pages,
    phrases,
    pii,
    quality,
    sharding,
    tokens,
)
from quillmill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
