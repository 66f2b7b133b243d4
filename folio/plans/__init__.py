"""Query plans: compositions of operators, registered by name."""

from folio.plans import (  # noqa: F401  (importing registers the queries)
    cleaning_queries,
    enrichment_queries,
    job_queries,
    retrieval_queries,
)
from folio.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
