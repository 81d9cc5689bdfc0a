"""All registered queries."""

from quarry.workload import (  # noqa: F401  (imported for registration)
    ingesting,
    predicate_queries,
    ranking_queries,
    search_queries,
    typing_and_text,
)
from quarry.workload.registry import ORACLES, QUERIES  # noqa: F401
