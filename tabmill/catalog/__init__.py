"""All registered queries."""

from tabmill.catalog import features, learning, tables, trees, values  # noqa: F401
from tabmill.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
