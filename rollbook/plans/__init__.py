"""Views over the test tables and the registered queries with their SQL checks."""

from __future__ import annotations


def _load() -> None:
    from rollbook.plans import (  # noqa: F401
        q_evaluate,
        q_functions,
        q_jobs,
        q_models,
        q_ordered,
        q_pages,
        q_sources,
        q_streams,
        q_tables,
    )


def all_queries():
    _load()
    from rollbook.plans.registry import QUERIES

    return QUERIES


def all_oracles():
    _load()
    from rollbook.plans.registry import ORACLE

    return ORACLE
