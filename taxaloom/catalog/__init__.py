"""Queries that run every operator on the test tables."""

from taxaloom.catalog import checklists, columns, edges, joins, lineages, reconciliation, reports, texts, windows  # noqa: F401
from taxaloom.catalog.registry import QUERIES, SQL  # noqa: F401
