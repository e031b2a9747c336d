"""All registered queries."""

from roadpulse.plans.catalog import aggregates, jobs, models, monitoring, scalars, stored, streams  # noqa: F401
from roadpulse.plans.catalog.core import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
