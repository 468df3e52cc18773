"""Every registered query of the library, by name, with its SQL."""

from __future__ import annotations

from quillmesh.plans import entity_queries, ingest_queries, page_queries, source_queries, star_queries, table_queries, text_queries

_MODULES = (text_queries, star_queries, entity_queries, page_queries, source_queries, table_queries, ingest_queries)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
