"""All registered queries."""

from martkit.catalog import files, marts, nested, relational, scalar  # noqa: F401
from martkit.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
