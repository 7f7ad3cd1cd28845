"""All queries of the core and their SQL."""

from __future__ import annotations

from keelgraph.plans import knowledge, quality, texts

_MODULES = (quality, texts, knowledge)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
FLAGSHIP = knowledge.nodes_csv
