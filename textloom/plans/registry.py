"""All queries of the library itself, by name, with their oracles."""

from __future__ import annotations

from textloom.plans import corpus_queries, glyph_queries, ledger_queries, page_queries, prose_queries, scan_queries, sequence_queries

MODULES = (corpus_queries, sequence_queries, prose_queries, ledger_queries, glyph_queries, page_queries, scan_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
