"""All registered queries."""

from skillweave.plans.catalog import matching_queries, model_queries, skill_queries, stage_queries, text_queries  # noqa: F401
from skillweave.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
