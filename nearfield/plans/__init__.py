"""Registered queries over the test tables."""

import importlib

MODULES = ("search_queries", "index_queries", "predicate_queries", "table_queries", "quality_queries", "log_queries", "stream_queries")


def load():
    """Import every query module and return (queries, oracles)."""
    from nearfield.plans import registry

    for name in MODULES:
        importlib.import_module(f"nearfield.plans.{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
