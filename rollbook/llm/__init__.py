"""Operators for preparing training text; nothing else in the library imports this package."""

from __future__ import annotations


def _load() -> None:
    from rollbook.llm import queries  # noqa: F401


def all_queries():
    _load()
    from rollbook.llm.registry import QUERIES

    return QUERIES


def all_oracles():
    _load()
    from rollbook.llm.registry import ORACLE

    return ORACLE
