"""All queries over the driver tables and, where SQL can say the same, their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("records", "graphs", "ordered", "pairs", "quality", "sampling", "assembly", "documents", "resolution")
_PARTS = [import_module(f"weft.plans.{m}") for m in MODULES]
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: q for part in _PARTS for name, q in part.SQL.items()}
FLAGSHIP = "canonical_elect"
