"""Registry of every checked query: name -> Spark callable, name -> DuckDB oracle SQL."""

from __future__ import annotations

from dimload.plans import flow_queries, load_queries, scd_queries, table_queries

_MODULES = [scd_queries, load_queries, table_queries, flow_queries]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
