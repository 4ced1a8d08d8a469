"""Queries over the test tables, each with the SQL that must give the same rows (or none)."""

from __future__ import annotations

from reviewloom.queries import conversations, neighbours, preparation, records, texts

MODULES = [preparation, records, texts, neighbours, conversations]
ALL = {name: pair for module in MODULES for name, pair in module.QUERIES.items()}
