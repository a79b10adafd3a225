"""All queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from voxmill.llm import chunks, decontaminate, frames, jaccard, pieces, rules, sitetree, subwords, toxicity, transcripts

MODULES = (decontaminate, rules, jaccard, sitetree, subwords, toxicity, transcripts, frames, pieces, chunks)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE: dict[str, str] = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
