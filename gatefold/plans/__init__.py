"""Queries over the driver tables, their SQL, and the batch pipeline."""

from gatefold.plans import queries_cohort, queries_gates, queries_gating, queries_stats  # noqa: F401
from gatefold.plans.registry import QUERIES, SQL  # noqa: F401
