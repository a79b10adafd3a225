"""Registry of the engine's own queries and their SQL."""

from __future__ import annotations

from voxmill.plans import segments, texts, vectors

MODULES = (segments, texts, vectors)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
