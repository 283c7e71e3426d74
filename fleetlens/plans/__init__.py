"""Registered queries, by family, each with the SQL it is checked against."""

from __future__ import annotations

from . import catalog, comparison, details, generic, pages, publishing, reconciliation, recovery, snapshots, texts

_FAMILIES = (catalog, reconciliation, comparison, texts, details, pages, recovery, publishing, snapshots, generic)

QUERIES = {name: q for family in _FAMILIES for name, q in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
