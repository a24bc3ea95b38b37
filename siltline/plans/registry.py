"""All registered queries and the SQL their results are checked against."""

from __future__ import annotations

from siltline.plans import entity_queries, layout_queries, star_queries, trip_queries

_MODULES = (trip_queries, star_queries, layout_queries, entity_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
