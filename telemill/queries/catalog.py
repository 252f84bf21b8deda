"""All registered queries."""

from . import build_queries, draw_queries, plan_queries, record_queries, series_queries

_MODULES = (series_queries, draw_queries, record_queries, build_queries, plan_queries)

QUERIES = {name: fn for m in _MODULES for name, fn in m.register.queries.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.register.oracle.items()}
