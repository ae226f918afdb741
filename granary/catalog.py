"""The registered queries and their oracle SQL."""

from granary.plans import file_queries, layer_queries, mart_queries, price_queries, profile_queries, table_queries  # noqa: F401
from granary.plans.registry import ORACLES, QUERIES  # noqa: F401
