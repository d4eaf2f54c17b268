"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from txmart.plans import q_clean, q_edges, q_job, q_mart, q_quality, q_reports  # noqa: F401  (registration side effects)
from txmart.plans.registry import ORACLE_SQL, QUERIES, portable

__all__ = ["QUERIES", "ORACLE_SQL", "portable"]
