"""Registry of all queries (name -> Spark callable) and their oracle SQL."""

from __future__ import annotations

from tessera.plans import catalog_clean, catalog_dedup, catalog_tokens

_MODULES = (catalog_clean, catalog_dedup, catalog_tokens)


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_sql():
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
