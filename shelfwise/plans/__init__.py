"""Named queries (Spark builders + SQL oracles)."""

from shelfwise.plans import analytics, content, evaluation, ingest, interactions, models, search  # noqa: F401  (registers)
from shelfwise.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
