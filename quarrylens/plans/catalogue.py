"""All queries of the library by name, and the SQL that states the same result."""

from quarrylens.plans import gold_queries, more_queries, relational_queries, text_queries, unit_queries  # noqa: F401  they register themselves
from quarrylens.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
