"""The registered queries: each a Spark plan over the given tables plus the SQL it must equal."""

from tablewright.workloads import (  # noqa: F401
    aggregation,
    changes,
    expressions,
    integrity,
    joining,
    loading,
    ranking,
    selection,
    viewing,
)
from tablewright.workloads.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
