"""All queries of the core and their SQL."""

from __future__ import annotations

from . import corpus, documents, estimates, ops, relational, texts, tools

_PARTS = (corpus, estimates, texts, documents, tools, ops, relational)
QUERIES: dict = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
