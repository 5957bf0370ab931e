"""Loads every module of registered queries."""

from __future__ import annotations

from . import (  # noqa: F401
    clauses,
    documents,
    facets,
    lookups,
    paging,
    ranking,
    text,
    vectors,
    watches,
    writes,
)
from .registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
