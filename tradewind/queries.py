"""All registered queries."""

from tradewind.plans import registry_business, registry_loads, registry_more  # noqa: F401  (each module adds its queries)
from tradewind.plans.registry import QUERIES

__all__ = ["QUERIES"]
