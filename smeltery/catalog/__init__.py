"""The registered queries, one group per module."""

from smeltery.catalog import checks, datasets, gold, layers, records, scalars, versions, work  # noqa: F401
from smeltery.catalog.registry import QUERIES

__all__ = ["QUERIES"]
