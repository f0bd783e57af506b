"""The operators bound to the test tables: one registered query per operator, with equivalent SQL."""

from panelscore.catalog.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
