"""Queries of the core by name, and the SQL of those that SQL can express."""

from tidemark.queries import catalog, general

QUERIES = catalog.QUERIES | general.QUERIES
SQL = catalog.SQL | general.SQL
